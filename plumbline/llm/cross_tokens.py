"""How two tokenizers cut the same texts, through an inverted index of token pairs.

Both tokenizers cut a text where a word follows a word after one space, so texts are cut there first and each different
chunk is tokenized and aligned once per task. Tokens of the two that share bytes are linked; byte offsets where both end
cut them into groups.

The index has a compressed bitmap of documents per pair of token ids and bucket of documents, and planes of bitmaps for
how much oftener than once a document holds the pair. Bitmaps of one bucket are merged by OR as batches come in; buckets
hold different documents, so counts of a pair are sums of popcounts. At last every bucket's postings return the counts
of their pairs to its documents.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain, islice, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import bounded_batches, stored

#: A pair is one number: the id of the first tokenizer, then this many bits for the second's.
B_BITS = 20
#: A posting is one number: the pair, then these bits for the document's place in its bucket.
PLACE_BITS = 16
BUCKET_DOCS = 50_000
BUCKET_POSTINGS = 3_000_000
#: Chunks that a task keeps the alignment of.
KEPT_CHUNKS = 400_000
SPACE = "▁"
#: A space with a visible character on either side; B can't tell its own space sign from a space.
_CUT = re.compile(rf"(?<=[^\s{SPACE}]) (?=\S)")
#: The plane of the documents that hold a pair; planes from 0 hold the bits of how often beyond once.
DOCUMENTS = -1


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies spell bytes: printable ones stand for themselves, others come after 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _spelled(n: int, marks: tuple[bytes, bytes]) -> np.ndarray:
    """For each id its number with either mark after it."""
    return np.array([b"%d%s" % (i, m) for i in range(n) for m in marks], object)


class Tokenizers:
    """A byte-level tokenizer (A) and a SentencePiece one (B) with the bytes of their tokens."""

    def __init__(self, a_json: bytes, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json.decode("utf-8"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        letters = _byte_letters()
        named = self.a.get_vocab()
        self.a_bytes = [b""] * (max(named.values()) + 1)
        for token, i in named.items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        if len(pieces) >> B_BITS:
            raise ValueError(f"the second tokenizer has {len(pieces)} pieces; at most {1 << B_BITS} are supported")
        self.a_spelled, self.b_spelled = _spelled(len(self.a_bytes), (b",", b"|")), _spelled(len(pieces), (b",", b";"))
        #: Whether B, too, ends a token wherever a word follows a word.
        self.cuts = not any(SPACE in p.lstrip(SPACE) for p in pieces)

    def a_ids(self, texts: Sequence[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(list(texts), add_special_tokens=False)]

    def b_ids(self, texts: Sequence[str]) -> list[list[int]]:
        return self.b.encode(list(texts), num_threads=1)


class Cut:
    """The tokens of one side over all chunks of a batch: ids, tokens per chunk, and where they end in the joined bytes."""

    def __init__(self, ids: list[list[int]], token_bytes: list[bytes]):
        self.counts = np.fromiter(map(len, ids), np.int64, len(ids))
        self.ids = np.fromiter(chain.from_iterable(ids), np.int64, int(self.counts.sum()))
        parts = [token_bytes[i] for i in self.ids.tolist()]
        self.ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)), dtype=np.int64)
        self.starts = np.concatenate([[0], self.ends])[: len(parts)]
        self.chunks = np.repeat(np.arange(len(ids)), self.counts)
        self.joined = b"".join(parts)

    def spells(self, raw: bytes, ends: np.ndarray) -> bool:
        """Whether the tokens give back ``raw``, each chunk ending where it should."""
        at = np.cumsum(self.counts)
        return self.joined == raw and bool((self.counts > 0).all()) and bool((self.ends[at - 1] == ends).all())


@lru_cache(maxsize=2)
def _tokenizers(a_json: bytes, b_model: bytes) -> Tokenizers:
    """Kept by a Python worker from one task to the next."""
    return Tokenizers(a_json, b_model)


def _ramp(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``counts[i]`` whole numbers from ``starts[i]`` on, one after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


class Alignments:
    """Alignments of chunks, each worked out once: numbers per chunk, its pairs, and its groups as text."""

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[bytes] = []
        self.valid = np.empty(0, bool)
        self.numbers = np.empty((0, 4), np.int64)  # n_a, n_b, n_groups, n_links
        self.pairs = np.empty(0, np.int64)

    def __len__(self) -> int:
        return len(self.known)

    def whole(self, text: str) -> list[int]:
        return [self.known.setdefault(text, len(self.known))]

    def chunks(self, text: str) -> list[int]:
        """Numbers of the chunks of ``text``, each of which stands for itself after a space."""
        if not self.tokenizers.cuts:
            return self.whole(text)
        known = self.known
        return [known.setdefault(c, len(known)) for c in _CUT.split(text)]

    def align(self) -> None:
        """Works out the chunks that are new since the last call."""
        fresh = list(islice(self.known, len(self.groups), None))
        for at in range(0, len(fresh), 20_000):
            self._align(fresh[at : at + 20_000])

    def _align(self, chunks: list[str]) -> None:
        t = self.tokenizers
        spaced = [f" {c}" for c in chunks]
        raw = [s.encode("utf-8", "replace") for s in spaced]
        ends = np.cumsum([len(r) for r in raw])
        a_ids, b_ids = t.a_ids(spaced), t.b_ids(chunks)
        a, b = Cut(a_ids, t.a_bytes), Cut(b_ids, t.b_bytes)
        valid = np.ones(len(chunks), bool)
        if not (a.spells(b"".join(raw), ends) and b.spells(b"".join(raw), ends)):
            valid = np.array([all(b"".join([x[i] for i in ids]) == r for ids, x in ((i, t.a_bytes), (j, t.b_bytes))) for i, j, r in zip(a_ids, b_ids, raw, strict=True)])
            a, b = (Cut([x if ok else [] for x, ok in zip(ids, valid, strict=True)], of) for ids, of in ((a_ids, t.a_bytes), (b_ids, t.b_bytes)))
        first = np.searchsorted(b.ends, a.starts, "right")
        count = np.searchsorted(b.starts, a.ends, "left") - first
        pairs = np.repeat(a.ids, count) << B_BITS | b.ids[_ramp(first, count)]
        cuts = np.intersect1d(a.ends, b.ends, assume_unique=True)
        a_group, b_group = np.searchsorted(cuts, a.ends), np.searchsorted(cuts, b.ends)
        a_last, b_last = np.diff(a_group, append=-1) != 0, np.diff(b_group, append=-1) != 0
        n_links = np.bincount(np.repeat(a.chunks, count), minlength=len(chunks))
        n_groups = np.bincount(a.chunks[a_last], minlength=len(chunks))
        # Both sides' tokens in the order of their groups, the first tokenizer's before the second's.
        spelled = np.empty(len(a.ids) + len(b.ids), object)
        spelled[np.arange(len(a.ids)) + np.searchsorted(b_group, a_group)] = t.a_spelled[2 * a.ids + a_last]
        spelled[np.arange(len(b.ids)) + np.searchsorted(a_group, b_group, "right")] = t.b_spelled[2 * b.ids + b_last]
        words, at = spelled.tolist(), [0, *np.cumsum(a.counts + b.counts).tolist()]
        self.groups += [b"".join(words[s:e])[:-1] for s, e in pairwise(at)]
        self.valid = np.concatenate([self.valid, valid])
        self.numbers = np.concatenate([self.numbers, np.stack([a.counts, b.counts, n_groups, n_links], axis=1)])
        self.pairs = np.concatenate([self.pairs, pairs])


def _counted(keys: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order and how often each occurs, or the sum of its ``times``."""
    if times is None:
        keys = np.sort(keys)
        starts = np.flatnonzero(np.diff(keys, prepend=-1))
        return keys[starts], np.diff(starts, append=len(keys))
    order = np.argsort(keys)
    keys, times = keys[order], times[order]
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[starts], np.add.reduceat(times, starts) if len(starts) else times


def bitmaps(pairs: np.ndarray, places: np.ndarray, n_places: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool, pa.Array]]:
    """Pairs, popcounts, whether bitmaps are dense, and the bitmaps: lists of places, or bits where these are shorter.

    ``pairs`` and ``places`` are sorted by pair, then place.
    """
    starts = np.flatnonzero(np.diff(pairs, prepend=-1))
    counts = np.diff(starts, append=len(pairs))
    dense = 16 * counts > n_places
    for kind in (False, True):
        mine = np.flatnonzero(dense == kind)
        if not len(mine):
            continue
        at = _ramp(starts[mine], counts[mine])
        if kind:
            bits = []
            for s, n in zip(starts[mine].tolist(), counts[mine].tolist(), strict=True):
                row = np.zeros(n_places, bool)
                row[places[s : s + n]] = True
                bits.append(np.packbits(row).tobytes())
            packed = pa.array(bits, pa.binary())
        else:
            offsets = np.concatenate([[0], 2 * np.cumsum(counts[mine])]).astype("<i4")
            packed = pa.Array.from_buffers(pa.binary(), len(mine), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(places[at].astype("<u2").tobytes())])
        yield pairs[starts[mine]], counts[mine], kind, packed


def places_of(bits: Sequence[bytes], dense: bool) -> np.ndarray:
    """The places in bitmaps, one bitmap after another."""
    if not dense:
        return np.frombuffer(b"".join(bits), "<u2").astype(np.int64)
    return np.concatenate([np.flatnonzero(np.unpackbits(np.frombuffer(b, "u1"))) for b in bits]) if bits else np.empty(0, np.int64)


class _Bucket:
    """Documents of a task and their postings until the bucket is full."""

    def __init__(self) -> None:
        self.rows: list[pa.Table] = []
        self.keys: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.docs = self.postings = 0

    def add(self, alignments: Alignments, ids: pa.Array, texts: list[str | None], digest: bool) -> None:
        chunks = [alignments.chunks(x) if x else [] for x in texts]
        alignments.align()
        for i, text in enumerate(texts):
            if text and not alignments.valid[chunks[i]].all():
                chunks[i] = alignments.whole(text)
        alignments.align()
        chunks = [c if c and alignments.valid[c].all() else [] for c in chunks]
        lengths = np.array([len(c) for c in chunks], np.int64)
        flat = np.fromiter((n for c in chunks for n in c), np.int64, int(lengths.sum()))
        sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(alignments.numbers[flat], axis=0)])
        ends = np.cumsum(lengths)
        numbers = sums[ends] - sums[ends - lengths]
        groups = [b";".join([alignments.groups[n] for n in c]) for c in chunks]
        told = [hashlib.sha256(g).hexdigest() if g else "" for g in groups] if digest else [g.decode() for g in groups]
        place = np.arange(self.docs, self.docs + len(texts))
        columns = [pa.array(place, pa.int64()), ids, *(pa.array(n, pa.int64()) for n in numbers.T), pa.array(told, pa.string())]
        self.rows.append(pa.table(columns, names=["place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"]))
        # Chunks that a document repeats count at once.
        held, times = _counted(np.repeat(place, lengths) << 32 | flat)
        chunk = held & 0xFFFFFFFF
        n_links = alignments.numbers[:, 3]
        count = n_links[chunk]
        pairs = alignments.pairs[_ramp((np.cumsum(n_links) - n_links)[chunk], count)]
        keys, times = _counted(pairs << PLACE_BITS | np.repeat(held >> 32, count), np.repeat(times, count))
        self.keys.append(keys)
        self.times.append(times)
        self.docs += len(texts)
        self.postings += len(keys)

    def full(self, more: int) -> bool:
        return self.postings >= BUCKET_POSTINGS or self.docs + more > BUCKET_DOCS

    def batches(self, bucket: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """The bucket's rows: one per document, then one per pair and plane."""

        def rows(table: pa.Table) -> Iterator[pa.RecordBatch]:
            n = table.num_rows
            own = {name: table[name] for name in table.column_names} | {"bucket": pa.array(np.full(n, bucket))}
            yield from pa.table([own[f.name] if f.name in own else pa.nulls(n, f.type) for f in schema], schema=schema).to_batches(20_000)

        yield from rows(pa.concat_tables(self.rows))
        keys, times = np.concatenate(self.keys), np.concatenate(self.times)
        order = np.argsort(keys, kind="stable")  # the batches' bitmaps merged
        pairs, places, beyond = keys[order] >> PLACE_BITS, keys[order] & ((1 << PLACE_BITS) - 1), times[order] - 1
        for plane in range(DOCUMENTS, int(beyond.max(initial=0)).bit_length()):
            held = slice(None) if plane == DOCUMENTS else beyond >> plane & 1 == 1
            for pair, count, dense, bits in bitmaps(pairs[held], places[held], self.docs):
                columns = [pa.array(pair, pa.int64()), pa.array([plane] * len(pair), pa.int32()), pa.array(count, pa.int64()), pa.array([dense] * len(pair)), bits]
                yield from rows(pa.table(columns, names=["pair", "plane", "n", "dense", "bits"]))


def build_index(docs: DataFrame, a_file: str, b_file: str, doc_id: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """The pair index of ``docs``, written to the shared folder.

    Rows without ``pair`` are documents: ``bucket, place, doc_id, n_a, n_b, n_groups, n_links, groups``. Rows with one hold a bitmap:
    ``bucket, pair, plane, n, dense, bits``. ``groups`` spells ids as ``a1,a2|b1;a3|b2,b3``, or has the SHA-256 of that with
    ``digest``. Texts that are null, empty, or not given back whole by the tokens of either tokenizer have no tokens. Every row
    is a document of its own, whatever its id; other columns are not read.

    ``a_file`` is the JSON of a byte-level tokenizer and ``b_file`` a SentencePiece model that puts a space before a text; both
    are read here and go to the tasks.
    """
    bounded_batches(docs.sparkSession)
    with open(a_file, "rb") as a, open(b_file, "rb") as b:
        files = a.read(), b.read()
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (
        f"bucket long, place long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, "
        "pair long, plane int, n long, dense boolean, bits binary"
    )
    step = min(10_000, BUCKET_DOCS)

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alignments, bucket, number, arrow = Alignments(_tokenizers(*files)), _Bucket(), TaskContext.get().partitionId() << 32, None
        for batch in batches:
            if arrow is None:
                long, text = pa.int64(), pa.string()
                kinds = [long, long, batch.schema.field(0).type, long, long, long, long, text, long, pa.int32(), long, pa.bool_(), pa.binary()]
                names = "bucket place doc_id n_a n_b n_groups n_links groups pair plane n dense bits".split()
                arrow = pa.schema(list(zip(names, kinds, strict=True)))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                if bucket.docs and bucket.full(part.num_rows):
                    yield from bucket.batches(number, arrow)
                    bucket, number = _Bucket(), number + 1
                if len(alignments) > KEPT_CHUNKS:
                    alignments.clear()
                bucket.add(alignments, part.column(0), part.column(1).to_pylist(), digest)
        if bucket.docs:
            yield from bucket.batches(number, arrow)

    return stored(rows.mapInArrow(indexed, schema))


def pair_counts(index: DataFrame) -> DataFrame:
    """``pair, a_id, b_id, n_docs, n_links, is_best`` of all linked pairs: documents that hold it, links, and whether no pair with its B id has more."""
    links = F.when(F.col("plane") == DOCUMENTS, F.col("n")).otherwise(F.expr("shiftleft(n, greatest(plane, 0))"))
    documents = F.when(F.col("plane") == DOCUMENTS, F.col("n"))
    counts = index.where("pair IS NOT NULL").groupBy("pair").agg(F.sum(documents).alias("n_docs"), F.sum(links).alias("n_links"))
    counts = counts.select(
        "pair", F.shiftright("pair", B_BITS).alias("a_id"), F.col("pair").bitwiseAND((1 << B_BITS) - 1).alias("b_id"), "n_docs", "n_links"
    )
    counts = stored(counts)
    highest = counts.groupBy("b_id").agg(F.max("n_links").alias("highest"))
    return counts.join(highest, "b_id").select(*counts.columns, (F.col("n_links") == F.col("highest")).alias("is_best"))


def score_documents(index: DataFrame, counts: DataFrame) -> DataFrame:
    """Each document of ``index`` with ``n_best``, its links whose pair is its B id's best, and ``count_sum``, the counts of its links' pairs."""
    told = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"]
    kinds = {f.name: f.dataType.simpleString() for f in index.schema}
    result = ", ".join(f"{c} {kinds[c]}" for c in told) + ", n_best long, count_sum long"
    # Only keys meet the counts, so bitmaps are shuffled once. Each pair has one bitmap of documents in a bucket.
    held = index.where(F.col("plane") == DOCUMENTS).select("pair", F.col("bucket").alias("of_bucket"))
    counted = held.join(counts.select("pair", F.col("n_links").alias("count"), "is_best"), "pair")
    counted = counted.selectExpr("of_bucket", "pair AS of_pair", "count", "is_best")

    def of_bucket(rows: pa.Table, counted: pa.Table) -> pa.Table:
        docs = rows.filter(pc.is_null(rows["pair"]))
        place = docs["place"].to_numpy()
        best, total = (np.zeros(int(place.max(initial=-1)) + 1, np.int64) for _ in range(2))
        by = np.argsort(counted["of_pair"].to_numpy())
        known, count, is_best = (counted[c].to_numpy()[by] for c in ("of_pair", "count", "is_best"))
        postings = rows.filter(pc.is_valid(rows["pair"])).select(["pair", "plane", "n", "dense", "bits"])
        for kind in (False, True):
            mine = postings.filter(pc.equal(postings["dense"], kind))
            for at in range(0, mine.num_rows, 100_000):
                part = mine.slice(at, 100_000)
                places, n = places_of(part["bits"].to_pylist(), kind), part["n"].to_numpy()
                times = np.int64(1) << np.maximum(part["plane"].to_numpy(), 0).astype(np.int64)
                pair = np.searchsorted(known, part["pair"].to_numpy())
                np.add.at(best, places, np.repeat(times * is_best[pair], n))
                np.add.at(total, places, np.repeat(times * count[pair], n))
        return docs.select(told).append_column("n_best", pa.array(best[place])).append_column("count_sum", pa.array(total[place]))

    return index.groupBy("bucket").cogroup(counted.groupBy("of_bucket")).applyInArrow(of_bucket, result)


def align_tokens(docs: DataFrame, a_file: str, b_file: str, doc_id: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """Every row of ``docs`` as ``doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum``.

    See ``build_index`` for what null, odd and repeated rows give; documents without tokens have zeros and empty groups. An
    empty table gives an empty one.
    """
    index = build_index(docs, a_file, b_file, doc_id, text, digest)
    return score_documents(index, pair_counts(index))
