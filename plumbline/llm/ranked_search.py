"""Ranked lexical search by Block-Max MaxScore over shards of compressed posting lists.

``build_index`` cuts the documents of each partition into shards of bounded size. A shard holds a posting list per term, in
blocks of 128 documents: places and frequencies are packed, and beside each block stands the front of its (frequency,
length) pairs that no other pair of the block beats. Whatever the corpus turns out to be, the best score in a block is that
of its front, so shards are written in one pass and can be searched together with others that come later.

``search`` joins terms with their document counts and brings shards and blocks of queries together. In a shard, lists are
ordered by their highest score: those that can't lift a document over the least of the best ones by themselves aren't essential. Documents are drawn
from essential lists only; the block maxima of the others reject most of them before a block is unpacked. The heaps of
all shards are merged by a window.

A term is a longest run of ASCII letters, digits and characters beyond ASCII; only A to Z are lower-cased. The score is the
whole-number form of a BM25 that the README gives.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import bounded_batches, stored, text_key

#: Every separator becomes a space; A to Z become a to z.
_FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
LONGEST_TERM = 64
SHARD_TERMS = 4_000_000
BLOCK = 128
WINDOW = 1024
QUERY_BLOCK = 1024
#: Most bytes of query terms that are sent to tasks as a filter; beyond that, every term is indexed.
FILTER_BYTES = 8 << 20
_BLOCK_TYPE = np.dtype([("first", "<u4"), ("last", "<u4"), ("at", "<u8"), ("n", "<u2"), ("gap", "u1"), ("tf", "u1"), ("front", "<u4")])
_WIDTHS = np.array([1, 2, 4], dtype="u1")


def terms_of(raw: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order; a very long one is replaced by a digest that no term can equal."""
    found = raw.translate(_FOLDED).split()
    if len(raw) > LONGEST_TERM:
        return [t if len(t) <= LONGEST_TERM else b" " + hashlib.blake2b(t, digest_size=16).digest() for t in found]
    return found


# --------------------------------------------------------------------------- index


def _width(highest: np.ndarray) -> np.ndarray:
    return _WIDTHS[(highest > 0xFF).astype(int) + (highest > 0xFFFF)]


def packed_lists(terms: np.ndarray, places: np.ndarray, tfs: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int, bytes, bytes, bytes]]:
    """Per term: its number, documents, block heads, fronts and packed blocks.

    ``terms``, ``places`` and ``tfs`` are postings by term and place; ``sizes`` the length of the document at each place.
    """
    starts = np.flatnonzero(np.diff(terms, prepend=-1))
    counts = np.diff(starts, append=len(terms))
    n_blocks = -(-counts // BLOCK)
    own = np.repeat(np.arange(len(starts)), n_blocks)
    nth = np.arange(len(own)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
    at = starts[own] + BLOCK * nth
    ends = np.minimum(at + BLOCK, (starts + counts)[own])
    gaps = np.diff(places, prepend=0)
    gaps[at] = 0
    gap_width, tf_width = _width(np.maximum.reduceat(gaps, at)), _width(np.maximum.reduceat(tfs, at))
    # Fronts: by falling frequency, those shorter than all before them in their block.
    of_block = np.repeat(np.arange(len(at)), ends - at)
    n = sizes[places].astype(np.int64)
    order = np.lexsort((n, -tfs, of_block))
    blocks, n = of_block[order], n[order]
    falling = n - blocks * (1 << 33)  # lower in every later block, so one running minimum serves all blocks
    least = np.minimum.accumulate(falling)
    on_front = np.empty(len(n), bool)
    on_front[:1], on_front[1:] = True, falling[1:] < least[:-1]
    fronts = np.stack([tfs[order][on_front], n[on_front]], axis=1).astype("<u4")
    front_at = np.searchsorted(blocks[on_front], np.arange(len(at) + 1))
    cast = {w: (gaps.astype(f"<u{w}").tobytes(), tfs.astype(f"<u{w}").tobytes()) for w in (1, 2, 4)}
    parts = [
        cast[g][0][g * s : g * e] + cast[t][1][t * s : t * e]
        for s, e, g, t in zip(at.tolist(), ends.tolist(), gap_width.tolist(), tf_width.tolist(), strict=True)
    ]
    heads = np.empty(len(at), _BLOCK_TYPE)
    heads["first"], heads["last"], heads["n"] = places[at], places[ends - 1], ends - at
    heads["gap"], heads["tf"] = gap_width, tf_width
    bounds = np.cumsum(n_blocks)
    for k, (b, e) in enumerate(zip((bounds - n_blocks).tolist(), bounds.tolist(), strict=True)):
        mine = heads[b:e]
        lengths = [len(p) for p in parts[b:e]]
        mine["at"] = np.cumsum([0, *lengths[:-1]])
        mine["front"] = front_at[b:e] - front_at[b]
        yield int(terms[starts[k]]), int(counts[k]), mine.tobytes(), fronts[front_at[b] : front_at[e]].tobytes(), b"".join(parts[b:e])


class _Shard:
    """Documents and postings that a task gathers until a shard is full."""

    def __init__(self, wanted: frozenset[bytes] | None):
        self.wanted = wanted
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.terms, self.tfs, self.lengths, self.sizes, self.ids = [], [], [], [], []
        self.total = 0

    def add(self, doc_id: pa.Scalar, raw: bytes) -> None:
        found = terms_of(raw)
        if not found:
            return
        counts = Counter(found if self.wanted is None else [t for t in found if t in self.wanted])
        numbers = self.numbers
        self.terms.append(np.fromiter((numbers.setdefault(t, len(numbers)) for t in counts), "<i4", len(counts)))
        self.tfs.append(np.fromiter(counts.values(), "<i4", len(counts)))
        self.lengths.append(len(counts))
        self.sizes.append(len(found))
        self.ids.append(doc_id)
        self.total += len(found)

    def rows(self, shard: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """The shard's rows: first its documents in the order of their ids, then a row per term."""
        ids = pa.array(self.ids, schema.field("ids").type.value_type)
        order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        sizes = np.array(self.sizes, np.int64)[order]
        places = np.repeat(place, self.lengths)
        terms, tfs = np.concatenate(self.terms).astype(np.int64), np.concatenate(self.tfs).astype(np.int64)
        by = np.argsort(terms << 32 | places, kind="stable")
        first = [shard, None, len(order), int(sizes.sum()), ids.take(order).to_pylist(), sizes.astype("<u4").tobytes(), None, None, None]
        yield pa.record_batch([pa.array([v], f.type) for v, f in zip(first, schema, strict=True)], schema=schema)
        names = list(self.numbers)
        if not names:
            return
        rows: list[tuple] = []
        n_bytes = 0
        for number, n_docs, heads, fronts, payload in packed_lists(terms[by], places[by], tfs[by], sizes):
            rows.append((shard, names[number], n_docs, None, None, None, heads, fronts, payload))
            n_bytes += len(payload) + len(heads) + len(fronts)
            if n_bytes > 4 << 20:
                yield _batch(rows, schema)
                rows, n_bytes = [], 0
        if rows:
            yield _batch(rows, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", wanted: frozenset[bytes] | None = None) -> DataFrame:
    """The index of ``docs``, written to the shared folder: per shard a row with its documents and a row per term.

    ``shard, term`` (null: the documents), ``n_docs, n_terms, ids, sizes, heads, fronts, payload``. Texts that are null or hold no
    term are in no shard. Rows without id and rows that repeat one are documents of their own; ids of any type that Arrow
    sorts will do. Other columns are not read. With ``wanted`` only lists of these terms are kept; lengths still count all terms.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("raw")).where("octet_length(raw) > 0")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"shard long, term binary, n_docs long, n_terms long, ids array<{kind}>, sizes binary, heads binary, fronts binary, payload binary"
    limit = SHARD_TERMS

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, number, arrow = _Shard(wanted), TaskContext.get().partitionId() << 32, None
        for batch in batches:
            if arrow is None:
                names = ("shard", "term", "n_docs", "n_terms", "ids", "sizes", "heads", "fronts", "payload")
                kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.list_(batch.schema.field(0).type), *[pa.binary()] * 4)
                arrow = pa.schema(list(zip(names, kinds, strict=True)))
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                gathered.add(doc, raw.as_py())
                if gathered.total >= limit:
                    yield from gathered.rows(number, arrow)
                    number += 1
                    gathered.clear()
        if gathered.total:
            yield from gathered.rows(number, arrow)

    return stored(rows.mapInArrow(indexed, schema))


# --------------------------------------------------------------------------- search


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term adds to a document's score, before its weight."""
    m = 25 + (75 * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Postings:
    """One term's list in a shard; blocks are unpacked when first asked for."""

    def __init__(self, heads: bytes, fronts: bytes, payload: bytes, sizes: np.ndarray, n_docs: int, n_terms: int):
        self.heads = np.frombuffer(heads, _BLOCK_TYPE)
        self.first, self.last = self.heads["first"].astype(np.int64), self.heads["last"].astype(np.int64)
        self.payload, self.sizes, self.corpus = payload, sizes, (n_docs, n_terms)
        front = np.frombuffer(fronts, "<u4").reshape(-1, 2).astype(np.int64)
        self.top = np.maximum.reduceat(impacts(front[:, 0], front[:, 1], n_docs, n_terms), self.heads["front"].astype(np.int64))
        self.best = int(self.top.max())
        self.unpacked: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and impacts of a block."""
        if i not in self.unpacked:
            _, _, at, n, gap, tf, _ = self.heads[i].item()
            gaps = np.frombuffer(self.payload, f"<u{gap}", n, at).astype(np.int64)
            tfs = np.frombuffer(self.payload, f"<u{tf}", n, at + gap * n).astype(np.int64)
            places = self.first[i] + np.cumsum(gaps)
            self.unpacked[i] = places, impacts(tfs, self.sizes[places], *self.corpus)
        return self.unpacked[i]

    def window_tops(self, n_windows: int) -> np.ndarray:
        """The highest impact of each window of places, as the blocks that reach into it tell."""
        tops = np.zeros(n_windows, np.int64)
        reach = self.last // WINDOW - self.first // WINDOW
        for step in range(int(reach.max()) + 1):  # a block of few documents may span many windows
            some = reach >= step
            np.maximum.at(tops, self.first[some] // WINDOW + step, self.top[some])
        return tops


def best_of_shard(lists: Sequence[tuple[Postings, int]], tops: Sequence[np.ndarray], n_places: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the ``k`` best documents for one query: highest scores above 0 first, then lowest places.

    ``lists`` holds the query's lists in this shard and their weights, ``tops`` their ``window_tops``.
    """
    order = sorted(range(len(lists)), key=lambda i: lists[i][0].best * lists[i][1])
    lists = [lists[i] for i in order]
    bounds = np.cumsum([p.best * w for p, w in lists])
    highest = np.cumsum([tops[i] * lists[j][1] for j, i in enumerate(order)], axis=0)  # of the first lists together, by window
    found, scores, least = np.empty(0, np.int64), np.empty(0, np.int64), 1
    for window in np.argsort(-highest[-1], kind="stable").tolist():
        if highest[-1][window] < least:
            break
        essential = int(np.searchsorted(bounds, least))  # lists before it stay below the least together
        low = window * WINDOW
        total = np.zeros(min(WINDOW, n_places - low), np.int64)
        for postings, weight in lists[essential:]:
            b, e = np.searchsorted(postings.last, low), np.searchsorted(postings.first, low + len(total))
            for i in range(int(b), int(e)):
                places, impact = postings.block(i)
                if i in (b, e - 1):
                    inside = slice(*np.searchsorted(places, (low, low + len(total))))
                    places, impact = places[inside], impact[inside]
                total[places - low] += weight * impact
        left = np.flatnonzero(total)
        for j in range(essential - 1, -1, -1):
            left = left[total[left] + highest[j][window] >= least]
            if not len(left):
                break
            postings, weight = lists[j]
            place = left + low
            at = np.searchsorted(postings.last, place)
            inside = at < len(postings.last)
            inside[inside] = postings.first[at[inside]] <= place[inside]
            bound = np.zeros(len(left), np.int64)
            bound[inside] = weight * postings.top[at[inside]]
            rest = highest[j - 1][window] if j else 0
            stays = total[left] + bound + rest >= least
            left, at, inside = left[stays], at[stays], inside[stays]
            for i in np.unique(at[inside]).tolist():
                places, impact = postings.block(i)
                asked = left[inside & (at == i)]
                where = np.minimum(np.searchsorted(places, asked + low), len(places) - 1)
                hit = places[where] == asked + low
                total[asked[hit]] += weight * impact[where[hit]]
        left = left[total[left] >= least]
        found, scores = np.concatenate([found, left + low]), np.concatenate([scores, total[left]])
        best = np.lexsort((found, -scores))[:k]
        found, scores = found[best], scores[best]
        if len(found) == k:
            least = int(scores[-1])  # an equal score may still win by its place
    return found, scores


def query_terms(items: DataFrame, text: str = "text") -> DataFrame:
    """``k1, k2, term, times`` of the different texts of ``items``, written to the shared folder."""
    body = F.col(f"`{text}`")
    texts = items.where(body.isNotNull()).select(*text_key(body), body.cast("binary").alias("raw"))
    texts = texts.groupBy("k1", "k2").agg(F.first("raw").alias("raw"))
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("term", pa.binary()), ("times", pa.int64())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k1, k2, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts = Counter(terms_of(raw))
                if counts:
                    yield _batch([(k1, k2, t, n) for t, n in counts.items()], schema)

    return stored(texts.mapInArrow(counted, "k1 long, k2 long, term binary, times long"))


def search(index: DataFrame, terms: DataFrame, k: int) -> DataFrame:
    """``k1, k2, rank, doc_id, score``: the ``k`` best documents for each query of ``terms``, all if fewer score above 0."""
    spark = index.sparkSession
    of_docs = index.where("term IS NULL")
    doc_type = index.schema["ids"].dataType.elementType.simpleString()
    n_docs, n_terms = of_docs.select(F.sum("n_docs"), F.sum("n_terms")).first()
    n_queries = terms.select("k1", "k2").distinct().count()
    result = f"k1 long, k2 long, doc_id {doc_type}, score long"
    if not n_docs or not n_queries:
        return spark.createDataFrame([], f"k1 long, k2 long, rank int, doc_id {doc_type}, score long")
    n_blocks = math.ceil(n_queries / QUERY_BLOCK)
    block = F.pmod(F.hash("k1", F.lit("block")), F.lit(n_blocks)).alias("block")

    asked = terms.select("term").distinct()
    lists = index.where("term IS NOT NULL").join(asked, "term", "left_semi")
    df = lists.groupBy("term").agg(F.sum("n_docs").alias("df"))
    ratio = (F.lit(2 * n_docs + 2).cast("double")) / (2 * F.col("df") + 1).cast("double")
    weight = F.floor(F.lit(1000.0) * F.log(ratio)) * F.col("times")
    weighted = terms.join(df, "term").select("k1", "k2", "term", weight.alias("weight")).where("weight > 0")
    queries = weighted.groupBy("k1", "k2").agg(F.collect_list("term").alias("terms"), F.collect_list("weight").alias("weights"))
    queries = queries.select(block, "k1", "k2", "terms", "weights")

    blocks = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block")
    shards = of_docs.select("shard", blocks)
    left = shards.join(queries, "block").selectExpr("shard AS to_shard", "block AS to_block", "k1", "k2", "terms", "weights")
    right = of_docs.unionByName(lists.select(index.columns)).select(*index.columns, blocks)

    def of_shard(key: tuple, asked: pa.Table, shard: pa.Table) -> pa.Table:
        kind = shard.schema.field("ids").type.value_type
        rows: list[tuple[int, int, int, int]] = []
        ids = None
        if asked.num_rows and shard.num_rows:
            names = shard.column("term").to_pylist()
            at = names.index(None)
            ids, lengths = shard.column("ids")[at].values, np.frombuffer(shard.column("sizes")[at].as_py(), "<u4").astype(np.int64)
            n_windows = -(-len(lengths) // WINDOW)
            where = {name: i for i, name in enumerate(names) if name is not None}
            packed = [shard.column(c) for c in ("heads", "fronts", "payload")]
            known: dict[bytes, tuple[Postings, np.ndarray]] = {}
            for k1, k2, terms, weights in zip(*(asked.column(c).to_pylist() for c in ("k1", "k2", "terms", "weights")), strict=True):
                lists = []
                for term, weight in zip(terms, weights, strict=True):
                    if term in where:
                        if term not in known:
                            postings = Postings(*(c[where[term]].as_py() for c in packed), lengths, n_docs, n_terms)
                            known[term] = postings, postings.window_tops(n_windows)
                        lists.append((*known[term], weight))
                if lists:
                    found, scores = best_of_shard([(p, w) for p, _, w in lists], [t for _, t, _ in lists], len(lengths), k)
                    rows += [(k1, k2, p, s) for p, s in zip(found.tolist(), scores.tolist(), strict=True)]
        columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
        docs = ids.take(pa.array(columns[2], pa.int64())) if rows else pa.array([], kind)
        return pa.table({"k1": pa.array(columns[0], pa.int64()), "k2": pa.array(columns[1], pa.int64()), "doc_id": docs, "score": pa.array(columns[3], pa.int64())})

    best = left.groupBy("to_shard", "to_block").cogroup(right.groupBy("shard", "block")).applyInArrow(of_shard, result)
    order = Window.partitionBy("k1", "k2").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("k1", "k2", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search_documents(
    docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text"
) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each row of ``items`` the ``k`` documents that score highest, best first.

    Equal scores go by ascending id, those without id last. Documents without terms are none; items that are null, hold no
    term or meet no document have no rows. Rows that repeat a document or an item count each; equal item texts are searched
    once. Tables may be empty and have any other columns; these are not returned.
    """
    terms = query_terms(items, text)
    asked = terms.select("term").distinct()
    size = asked.agg(F.sum(F.octet_length("term") + 64)).first()[0] or 0
    wanted = frozenset(bytes(r["term"]) for r in asked.toLocalIterator()) if size <= FILTER_BYTES else None
    found = search(build_index(docs, doc_id, text, wanted), terms, k)
    keys = items.select(F.col(f"`{item_id}`").alias("item_id"), *text_key(F.col(f"`{text}`"))).where(F.col(f"`{text}`").isNotNull())
    return keys.join(found, ["k1", "k2"]).select("item_id", "rank", "doc_id", "score")
