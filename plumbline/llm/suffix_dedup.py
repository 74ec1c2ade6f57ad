"""Removal of long byte strings that occur more than once, by a sparse suffix array.

Every string of ``min_bytes`` has an anchor: the place of its least k-gram hash, the first of equals. Equal strings have
their anchors at the same place, so it is enough to look at suffixes that begin at anchors, about one in 130 bytes.
Neighbouring strings with one anchor form a block. Blocks are classed by their anchor's k-gram:

- a class with one occurrence holds nothing that is repeated;
- a block that occurs twice as a whole is removed as a whole, wherever it occurs;
- of a class with different blocks, what stands after and before the anchors is put in order by deep-shallow sorting.
  Two strings with l bytes before the anchor are equal if they have the same place among prefixes of their left and right
  sides; counting equal pairs of places for every l tells which strings occur twice.

Whole classes meet in one task. One with more different blocks than ``LARGE_CLASS`` (a passage in very many documents,
each time with other neighbours) is split instead: its strings are dealt by their 128-bit hashes, and counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import bounded_batches, hinted, partitions_of, stored, text_key, text_or_empty, without
from plumbline.llm.suffix_sort import deep_shallow_order, neighbours_prefix

MIN_BYTES = 400
LARGE_CLASS = 2000
POOL = 3000  # blocks sorted together
CHUNK = 1 << 20  # bytes hashed together
ADDED = ["kept_bytes", "n_bytes", "n_removed", "n_spans"]
BLOCK = "h long, b long, k1 long, k2 long, at long, left int, many int"

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n + 1, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


class Anchors:
    """Blocks of strings with one anchor."""

    def __init__(self, min_bytes: int) -> None:
        self.size = min_bytes
        self.gram = max(1, min_bytes // 3)
        self.span = min_bytes - self.gram + 1  # k-grams in a string
        self.letters = _mixed(np.arange(1, 257, dtype=np.uint64))
        self.powers = self.inverses = np.zeros(0, np.uint64)

    def of_chunk(self, data: bytes, ends: np.ndarray, starts: np.ndarray) -> list[tuple[int, ...]]:
        """``document, h, b, start, left, many`` of the blocks of documents ``[start, end)`` in ``data``."""
        n = len(data)
        if n < self.size:
            return []
        if len(self.powers) < n + 1:
            self.powers, self.inverses = _powers(BASE, n), _powers(INVERSE, n)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(self.letters[np.frombuffer(data, np.uint8)] * self.powers[:n], dtype=np.uint64)])
        grams = _mixed((sums[self.gram :] - sums[: -self.gram]) * self.inverses[: n - self.gram + 1])
        least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        reach = 1
        while reach * 2 <= self.span:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < self.span:
            least = np.minimum(least[: len(least) - (self.span - reach)], least[self.span - reach :])
        document = np.repeat(np.arange(len(ends)), ends - starts)[: len(least)]
        place = np.flatnonzero(np.arange(len(least)) + self.size <= ends[document])
        if not len(place):
            return []
        anchor = (least[place] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (np.diff(place) != 1)]))
        low, high = place[first], place[np.append(first[1:], len(place)) - 1]
        anchor, document = anchor[first], document[low]
        view, seen = memoryview(data), grams[anchor].view(np.int64).tolist()
        left, many = anchor - low, high - low + 1
        return [
            (d, h, xxhash.xxh3_64_intdigest(view[s : e + self.size], seed=x) - (1 << 63), s - o, x, m)
            for d, h, s, e, x, m, o in zip(
                document.tolist(), seen, low.tolist(), high.tolist(), left.tolist(), many.tolist(), starts[document].tolist(), strict=True
            )
        ]

    def blocks(self, texts: list[bytes]) -> Iterator[list[tuple[int, ...]]]:
        """Blocks of many texts, in chunks of bounded size; a long text is cut into overlapping pieces."""
        parts: list[tuple[int, int, bytes]] = []
        total = 0

        def flush() -> list[tuple[int, ...]]:
            ends = np.cumsum([len(p) for *_, p in parts])
            starts = ends - [len(p) for *_, p in parts]
            found = self.of_chunk(b"".join(p for *_, p in parts), ends, starts)
            return [(parts[d][0], h, b, s + parts[d][1], x, m) for d, h, b, s, x, m in found]

        for i, text in enumerate(texts):
            for offset in range(0, max(1, len(text) - self.size + 1), CHUNK):
                piece = text[offset : offset + CHUNK + self.size - 1]
                if len(piece) < self.size:
                    continue
                parts.append((i, offset, piece))
                total += len(piece)
                if total >= CHUNK:
                    yield flush()
                    parts, total = [], 0
        if parts:
            yield flush()


def _utf8(texts: list[str]) -> list[bytes]:
    return [t.encode("utf-8", "replace") for t in texts]


def _blocks(bodies: DataFrame, min_bytes: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(min_bytes)
        for batch in batches:
            k1, k2 = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for rows in anchors.blocks(_utf8(batch.column(2).to_pylist())):
                if rows:
                    d, h, b, at, left, many = zip(*rows, strict=True)
                    keys = [[k[i] for i in d] for k in (k1, k2)]
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip((h, b, *keys, at, left, many), kinds, strict=True)],
                        ["h", "b", "k1", "k2", "at", "left", "many"],
                    )

    return bodies.mapInArrow(cut, BLOCK)


def repeated_in_pool(min_bytes: int, classes: np.ndarray, blocks: list[bytes], left: np.ndarray, many: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """For each block which of its strings occur more than once in the pool. ``weight`` is 2 for blocks that themselves do."""
    n, anchors = len(blocks), Anchors(min_bytes)
    width = [-(-w // 8) * 8 for w in (min_bytes, max(1, anchors.span - 1))]
    after, before = (np.zeros((n, w), np.uint8) for w in width)
    for i, block in enumerate(blocks):
        data = np.frombuffer(block, np.uint8)
        right = data[left[i] : left[i] + min_bytes]
        after[i, : len(right)] = right
        before[i, : left[i]] = data[: left[i]][::-1]
    lengths = np.arange(anchors.span)  # bytes of a string that stand before its anchor
    key = np.zeros((n, len(lengths)), np.int64)
    for rows, needed, shallow in ((after, min_bytes - lengths, anchors.gram + 64), (before, lengths, 64)):
        order = deep_shallow_order(rows, classes, shallow)
        prefix = neighbours_prefix(rows, classes, order)
        place = np.empty_like(key)
        place[order] = np.cumsum(prefix[:, None] < needed[None, :], axis=0)
        key = key * (n + 1) + place
    own = (lengths[None, :] <= left[:, None]) & (lengths[None, :] > (left - many)[:, None])
    i, l = np.nonzero(own)
    _, same = np.unique(l * np.int64(n + 1) ** 2 + key[i, l], return_inverse=True)
    repeated = np.bincount(same, weights=weight[i])[same] >= 2
    found = np.zeros(own.shape, bool)
    found[i, l] = repeated
    return [found[j, left[j] - many[j] + 1 : left[j] + 1][::-1] for j in range(n)]  # by start


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _sorted_spans(contexts: DataFrame, min_bytes: int) -> DataFrame:
    """Spans of repeated strings in blocks that occur once; rows of a class (``h``) meet in one task."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool: dict[str, list] = {}

        def spans(part: dict[str, list]) -> pa.RecordBatch:
            left, many = np.array(part["left"]), np.array(part["many"])
            weight = np.minimum(np.array(part["c"]), 2)
            found = repeated_in_pool(min_bytes, np.array(part["h"]), part["bytes"], left, many, weight)
            rows = []
            for i, flags in enumerate(found):
                if weight[i] == 1:
                    for a, b in zip(*_runs(flags), strict=True):
                        at = part["at"][i]
                        rows.append((part["k1"][i], part["k2"][i], at + int(a), at + int(b) - 1 + min_bytes))
            columns = zip(*rows, strict=True) if rows else ((), (), (), ())
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["k1", "k2", "start", "end"])

        for batch in batches:
            for name, values in batch.to_pydict().items():
                pool.setdefault(name, []).extend(values)
            h = pool["h"]
            if len(h) >= POOL:  # all but the last class, which may go on
                whole = next((i for i in range(len(h) - 1, 0, -1) if h[i] != h[i - 1]), 0)
                at = 0
                while at < whole:
                    to = min(at + POOL, whole)
                    while to < whole and h[to] == h[to - 1]:
                        to += 1
                    yield spans({k: v[at:to] for k, v in pool.items()})
                    at = to
                pool = {k: v[whole:] for k, v in pool.items()}
        if pool.get("h"):
            yield spans(pool)

    spread = contexts.repartition(partitions_of(contexts.sparkSession), "h").sortWithinPartitions("h")
    return spread.mapInArrow(search, "k1 long, k2 long, start long, end long")


def _dealt_spans(contexts: DataFrame, min_bytes: int) -> DataFrame:
    """The same for classes of any size: strings are dealt by their hashes."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data, n = memoryview(row["bytes"]), row["many"]
                hashes = b"".join(xxhash.xxh3_128_digest(data[i : i + min_bytes]) for i in range(n))
                pairs = np.frombuffer(hashes, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(row["at"] + np.arange(n)),
                        *[pa.array([row[c]] * n, pa.int64()) for c in ("k1", "k2", "c")],
                    ],
                    ["w1", "w2", "start", "k1", "k2", "c"],
                )

    every = contexts.mapInArrow(strings, "w1 long, w2 long, start long, k1 long, k2 long, c long")
    repeated = every.groupBy("w1", "w2").agg(F.sum("c").alias("total")).where("total > 1").select("w1", "w2")
    held = every.where("c = 1").join(repeated, ["w1", "w2"])
    return held.select("k1", "k2", "start", (F.col("start") + min_bytes).alias("end"))


def _contexts(bodies: DataFrame, blocks: DataFrame, min_bytes: int) -> DataFrame:
    """``blocks`` with their ``bytes``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = text.encode("utf-8", "replace")
                out = [r | {"bytes": data[r["at"] : r["at"] + r["many"] - 1 + min_bytes]} for r in rows]
                yield pa.RecordBatch.from_pylist(out, schema)

    names = ["h", "k1", "k2", "at", "left", "many", "c", "d"]
    kinds = {"left": pa.int32(), "many": pa.int32()}
    schema = pa.schema([(n, kinds.get(n, pa.int64())) for n in names] + [("bytes", pa.binary())])
    by_text = blocks.groupBy("k1", "k2").agg(F.collect_list(F.struct(*names)).alias("blocks"))  # no more than the text has
    keys = stored(blocks.select("k1", "k2").distinct())
    texts = bodies.join(hinted(keys, keys.count() * 16), ["k1", "k2"]).groupBy("k1", "k2").agg(F.first("text").alias("text"))
    return texts.join(by_text, ["k1", "k2"]).select("text", "blocks").mapInArrow(
        cut, "h long, k1 long, k2 long, at long, left int, many int, c long, d long, bytes binary"
    )


def repeated_spans(docs: DataFrame, text: str = "text", min_bytes: int = MIN_BYTES, large_class: int = LARGE_CLASS) -> DataFrame:
    """``k1, k2, start, end``: bytes that strings of ``min_bytes`` cover that occur anywhere else. Spans may overlap."""
    bounded_batches(docs.sparkSession)
    body = text_or_empty(f"`{text}`")
    bodies = docs.select(*text_key(body), body.alias("text")).where(F.octet_length("text") >= min_bytes)
    blocks = _blocks(bodies, min_bytes)
    seen = stored(blocks.groupBy("h").agg(F.count("*").alias("total")).where("total > 1").select("h"))
    repeated = stored(blocks.join(hinted(seen, seen.count() * 8), "h"))

    place = F.struct("k1", "k2", "at", "left", "many")
    different = repeated.groupBy("h", "b").agg(F.count("*").alias("c"), F.min(place).alias("one"))
    different = stored(different.select("h", "b", "c", "one.*"))
    whole = different.where("c > 1").select("h", "b")
    full = repeated.join(whole, ["h", "b"]).select("k1", "k2", F.col("at").alias("start"), (F.col("at") + F.col("many") - 1 + min_bytes).alias("end"))

    classes = different.groupBy("h").agg(F.count("*").alias("d")).where("d > 1")
    contexts = stored(_contexts(bodies, different.join(classes, "h"), min_bytes))
    mixed = _sorted_spans(contexts.where(F.col("d") <= large_class).drop("d"), min_bytes)
    mixed = mixed.union(_dealt_spans(contexts.where(F.col("d") > large_class), min_bytes))
    return full.union(mixed).distinct()


def _without_spans(data: bytes, starts: list[int], ends: list[int]) -> tuple[bytes, int]:
    """What is left, and the number of maximal removed runs."""
    kept, at, runs = [], 0, 0
    for start, end in sorted(zip(starts, ends, strict=True)):
        if start > at or not runs:
            kept.append(data[at:start])
            runs += 1
            at = end
        at = max(at, end)
    kept.append(data[at:])
    return b"".join(kept), runs


def remove_repeats(docs: DataFrame, text: str = "text", min_bytes: int = MIN_BYTES, large_class: int = LARGE_CLASS) -> DataFrame:
    """Every row of ``docs`` with ``kept_bytes`` (binary), ``n_bytes``, ``n_removed`` and ``n_spans`` (removed runs).

    A text is its UTF-8 bytes. Each byte covered by a string of ``min_bytes`` bytes that also begins anywhere else, in another
    row or in the same one, is removed; strings don't cross rows and are judged on the input. A null or empty text has no bytes.
    Rows with equal texts repeat each other, whatever their other columns. Columns of the names added are replaced.
    """
    kept_columns = without(docs, ADDED)
    spans = repeated_spans(docs, text, min_bytes, large_class)
    of_text = spans.groupBy("k1", "k2").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))

    @F.pandas_udf("kept_bytes binary, n_bytes long, n_removed long, n_spans long")
    def cut(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
        rows = []
        for body, s, e in zip(texts, starts, ends, strict=True):
            data = body.encode("utf-8", "replace")
            kept, runs = (data, 0) if s is None else _without_spans(data, s.tolist(), e.tolist())
            rows.append((kept, len(data), len(data) - len(kept), runs))
        return pd.DataFrame(rows, columns=["kept_bytes", "n_bytes", "n_removed", "n_spans"])

    body = text_or_empty(f"`{text}`")
    rows = kept_columns.select(F.struct("*").alias("row"), *text_key(body))
    joined = rows.join(of_text, ["k1", "k2"], "left")
    # Not to be worked out a second time where a caller filters by its numbers.
    once = cut.asNondeterministic()
    found = joined.select("row", once(text_or_empty(F.col("row").getField(text)), "starts", "ends").alias("f"))
    return found.select(*[F.col(f"row.`{c}`").alias(c) for c in kept_columns.columns], "f.*")
