"""Groups of near-duplicate documents by min-max hashing.

Each document's set of word shingles is hashed by some permutations. Of each permutation both the least and the largest
value are kept: either agrees between two documents with a probability equal to their Jaccard similarity, so half the
hash evaluations give the same number of values. Values are banded; documents that agree in a band are candidates, and
links are confirmed on their full sets.

Documents with equal sets are one node. Pairs within a bucket are not made at large. Each node is first compared with the
hubs it meets, the nodes with the most company in its buckets: in a family of copies the hub is the one closest to all. After
that, only nodes outside the largest component of a bucket are compared with the others of the bucket, and only pairs that a
bound on their difference allows: each set has a bitmap of 1,024 parities of its hashes, and two sets differ in at least as
many shingles as their bitmaps differ in bits. The bound loses no link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import bounded_batches, hinted, stored, text_key, text_or_empty, without
from plumbline.llm.components import connected_components

SHINGLE = 5
PERCENT = 80
PERMUTATIONS = 48  # twice as many values
BAND = 4  # values in a band: at 80 % a pair is missed by all 24 bands once in 300,000
ADDED = ["n_shingles", "component_id", "kept"]
KEPT_WORDS = 100_000
SLICE = 1 << 14
PARITY_LONGS = 16


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of word shingles as sorted 64-bit hashes; the hashes of words are kept up to a bound."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.words: dict[bytes, int] = {}

    def hashes(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A to Z and ASCII white space only
        if not words:
            return np.zeros(0, np.uint64)
        known = self.words
        if len(known) > KEPT_WORDS:
            known.clear()
        found = [known.get(w) for w in words]
        if None in found:
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh64_intdigest(w)
            found = [known[w] for w in words]
        codes = np.array(found, np.uint64)
        size = min(self.size, len(codes))
        total = np.full(len(codes) - size + 1, size, np.uint64)
        for k in range(size):
            total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + codes[k : len(codes) - size + 1 + k])
        return np.unique(total)


class MinMax:
    """Bands of the least and largest values under random permutations."""

    def __init__(self, permutations: int, band: int) -> None:
        drawn = np.random.Generator(np.random.PCG64(11)).integers(0, 2**64, (2, permutations), np.uint64)
        self.factors, self.shifts, self.band = drawn[0][:, None] | np.uint64(1), drawn[1][:, None], band

    def bands(self, hashes: np.ndarray) -> np.ndarray:
        low, high = [], []
        for at in range(0, len(hashes), SLICE):
            values = hashes[None, at : at + SLICE] * self.factors + self.shifts
            low.append(values.min(axis=1))
            high.append(values.max(axis=1))
        values = np.concatenate([np.min(low, axis=0), np.max(high, axis=0)])
        values = values[: len(values) // self.band * self.band].reshape(-1, self.band)
        keys = np.arange(1, len(values) + 1, dtype=np.uint64)
        for k in range(self.band):
            keys = _mixed(keys * np.uint64(0x9E3779B97F4A7C15) + values[:, k])
        return keys.view(np.int64)


def _parities(hashes: np.ndarray) -> np.ndarray:
    """For each of 1,024 places whether an odd number of hashes falls on it."""
    places = ((hashes * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(54)).astype(np.int64)
    return np.packbits(np.bincount(places, minlength=64 * PARITY_LONGS).astype(np.uint8) & 1).view(np.int64)


def _set_key(hashes: np.ndarray) -> tuple[int, int]:
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), np.int64).tolist())


def _signatures(docs: DataFrame, text: str, doc_id: str, shingle: int, permutations: int, band: int) -> DataFrame:
    """``k1, k2, doc_id, n, s1, s2, bands, parity`` of every row: text, id, size and key of its set, its bands and parities."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, minmax = Shingler(shingle), MinMax(permutations, band)
        for batch in batches:
            rows = []
            for body in batch.column(3):
                hashes = shingler.hashes(body.as_py())
                rows.append((len(hashes), *_set_key(hashes), minmax.bands(hashes) if len(hashes) else [], _parities(hashes)))
            columns = zip(*rows, strict=True) if rows else [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *[pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]],
                ["k1", "k2", "doc_id", "n", "s1", "s2", "bands", "parity"],
            )

    body = text_or_empty(f"`{text}`")
    rows = docs.select(*text_key(body), F.col(f"`{doc_id}`").alias("doc_id"), body.alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(signed, f"k1 long, k2 long, doc_id {kind}, n long, s1 long, s2 long, bands array<long>, parity array<long>")


def _full_sets(docs: DataFrame, text: str, nodes: DataFrame, shingle: int) -> DataFrame:
    """``id, hashes`` of ``nodes`` (``id, k1, k2``)."""

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(shingle)
        for batch in batches:
            sets = [shingler.hashes(t.as_py()).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["id", "hashes"])

    body = docs.select(text_or_empty(f"`{text}`").alias("text"))
    held = body.select(*text_key(F.col("text")), "text").join(hinted(nodes, nodes.count() * 24), ["k1", "k2"])
    once = held.groupBy("id").agg(F.first("text").alias("text"))  # copies are collapsed before the shuffle
    return once.mapInArrow(shingled, "id long, hashes array<long>")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are alike enough."""

    @F.pandas_udf("boolean")
    def alike(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(left, right, strict=True):
            both = len(a) + len(b) - len(np.union1d(a, b))
            out.append(100 * both >= percent * (len(a) + len(b) - both))
        return pd.Series(out, dtype=bool)

    left = sets.select(F.col("id").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("hashes").alias("y"))
    return pairs.join(left, "a").join(right, "b").where(alike("x", "y")).select("a", "b")


def _components_of(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """Every row of ``nodes`` (``id``, ...) with its ``component``."""
    found = connected_components(links)
    return nodes.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))


def _could_link(percent: int) -> Column:
    """Whether sizes ``n_a, n_b`` and parities allow the similarity: the parities' bits are no more than the sets' difference."""
    bits = " + ".join(f"bit_count(parity_a[{i}] ^ parity_b[{i}])" for i in range(PARITY_LONGS))
    return F.expr(f"({bits}) * {100 + percent} <= (n_a + n_b) * {100 - percent}")


def _side(df: DataFrame, name: str) -> DataFrame:
    return df.select(*[F.col(c).alias(name if c == "id" else c if c == "band" else f"{c}_{name}") for c in df.columns])


def _groups(docs: DataFrame, nodes: DataFrame, text: str, shingle: int, percent: int) -> DataFrame:
    """``id, component`` of the nodes that share a bucket with another one."""
    buckets = nodes.select("id", F.explode("bands").alias("band"))
    sizes = buckets.groupBy("band").agg(F.count("*").alias("c")).where("c > 1")
    meeting = stored(buckets.join(sizes, "band"))
    company = stored(meeting.groupBy("id").agg(F.sum("c").alias("company")))
    ids = company.select("id")
    known = stored(nodes.select("id", "n", "parity").join(ids, "id"))
    sets = stored(_full_sets(docs, text, nodes.select("id", "k1", "k2").join(ids, "id"), shingle))
    pair = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]

    hubs = meeting.join(company, "id").groupBy("band").agg(F.max(F.struct("company", "id")).alias("hub")).select("band", F.col("hub.id").alias("b"))
    met = meeting.join(hubs, "band").where("id <> b").select(F.col("id").alias("a"), "b").select(*pair).distinct()
    tested = stored(met.join(_side(known, "a"), "a").join(_side(known, "b"), "b").where(_could_link(percent)).select("a", "b"))
    links = stored(_linked(tested, sets, percent))
    of = stored(_components_of(ids, links))

    placed = meeting.select("band", "id").join(of, "id")
    counts = placed.groupBy("band", "component").agg(F.count("*").alias("c")).groupBy("band")
    split = counts.agg(F.max(F.struct("c", "component")).alias("most"), F.count("*").alias("parts")).where("parts > 1")
    rest = stored(placed.join(split.select("band", F.col("most.component").alias("main")), "band").join(known, "id"))
    outside, every = _side(rest.where("component <> main").drop("main"), "a"), _side(rest.drop("main"), "b")
    apart = outside.join(every, "band").where((F.col("component_a") != F.col("component_b")) & _could_link(percent))
    last = stored(apart.select("a", "b").select(*pair).distinct().join(tested, ["a", "b"], "left_anti"))
    more = stored(_linked(last, sets, percent))
    if more.isEmpty():
        return of
    # Only components are joined now, each a node of its own.
    ends = [of.select(F.col("id").alias(c), F.col("component").alias(f"c{c}")) for c in "ab"]
    between = more.join(ends[0], "a").join(ends[1], "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    merged = connected_components(between).select(F.col("id").alias("component"), F.col("component").alias("joined"))
    return of.join(merged, "component", "left").select("id", F.coalesce("joined", "component").alias("component"))


def _labelled(
    docs: DataFrame, text: str, doc_id: str, shingle: int, percent: int, permutations: int, band: int
) -> tuple[DataFrame, DataFrame]:
    """The signatures of every row, and ``s1, s2, id, least_doc, component`` of every set that isn't empty."""
    bounded_batches(docs.sparkSession)
    signatures = stored(_signatures(docs, text, doc_id, shingle, permutations, band))
    by_set = signatures.where("n > 0").groupBy("s1", "s2", "n")
    nodes = by_set.agg(F.first("bands").alias("bands"), F.first("parity").alias("parity"), F.min("doc_id").alias("least_doc"), F.min(F.struct("k1", "k2")).alias("key"))
    nodes = stored(nodes.select("s1", "s2", "n", "bands", "parity", "least_doc", "key.*").withColumn("id", F.monotonically_increasing_id()))
    groups = stored(_groups(docs, nodes, text, shingle, percent))
    labelled = nodes.select("s1", "s2", "id", "least_doc").join(groups, "id", "left").withColumn("component", F.coalesce("component", "id"))
    return signatures, stored(labelled)


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    permutations: int = PERMUTATIONS,
    band: int = BAND,
) -> DataFrame:
    """Every row of ``docs`` with ``n_shingles``, ``component_id`` and ``kept``.

    Words are runs of other characters than ASCII white space, A to Z in lower case. A set holds the different runs of
    ``shingle`` words; a text with fewer words has its whole sequence as its only one. Two documents are linked if their sets'
    Jaccard similarity is at least ``percent`` per cent. ``component_id`` is the smallest ``doc_id`` that links lead to, the
    document's own included; ``kept`` says that it is the document's own. Null, empty and blank texts have no shingles, are
    linked with nothing and kept. A row without id is linked like others, but names no component and is never kept unless it
    has no shingles; if no row of a component has an id, ``component_id`` is null. Rows with equal ids are one document: they
    are kept or not together. Columns of the names added are replaced. An empty table gives an empty result.
    """
    kept_columns = without(docs, ADDED)
    signatures, labelled = _labelled(docs, text, doc_id, shingle, percent, permutations, band)
    least = labelled.groupBy("component").agg(F.min("least_doc").alias("group_doc"))
    of_set = labelled.join(least, "component").select("s1", "s2", "group_doc")
    texts = signatures.select("k1", "k2", "n", "s1", "s2").distinct().join(of_set, ["s1", "s2"], "left")

    rows = kept_columns.select(F.struct("*").alias("row"), *text_key(text_or_empty(f"`{text}`")))
    joined = rows.join(texts.select("k1", "k2", "n", "group_doc"), ["k1", "k2"])
    own = F.col(f"row.`{doc_id}`")
    component = F.when(F.col("n") == 0, own).otherwise(F.col("group_doc"))
    return joined.select(
        *[F.col(f"row.`{c}`").alias(c) for c in kept_columns.columns], F.col("n").alias("n_shingles"), component.alias("component_id"),
        ((F.col("n") == 0) | F.coalesce(own == F.col("group_doc"), F.lit(False))).alias("kept"),
    )


def one_of_each(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    permutations: int = PERMUTATIONS,
    band: int = BAND,
) -> DataFrame:
    """One row of each component of ``near_duplicates``, and every row whose text has no shingles.

    The row of the smallest ``doc_id`` stays, nulls last; of several the one whose text has the smallest key, and any one of
    rows equal in id and text. So copies go also where ids are missing or repeated. Columns are those of ``docs``.
    """
    signatures, labelled = _labelled(docs, text, doc_id, shingle, percent, permutations, band)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2")
    of_set = signatures.where("n > 0").groupBy("s1", "s2").agg(F.min(place).alias("first"))
    of_component = of_set.join(labelled.select("s1", "s2", "component"), ["s1", "s2"]).groupBy("component").agg(F.min("first").alias("first"))
    firsts = stored(of_component.select("first.k1", "first.k2", F.col("first.doc_id").alias("first_doc")))
    size = firsts.count() * 40
    equal = signatures.select("k1", "k2", "doc_id").join(hinted(firsts, size), ["k1", "k2"]).where(F.col("doc_id").eqNullSafe(F.col("first_doc")))
    counted = equal.groupBy("k1", "k2", "first_doc").agg((F.count("*") > 1).alias("several")).withColumn("blank", F.lit(False))
    blank = signatures.where("n = 0").select("k1", "k2").distinct()
    blank = blank.select("k1", "k2", F.lit(None).cast(firsts.schema["first_doc"].dataType).alias("first_doc"), F.lit(False).alias("several"), F.lit(True).alias("blank"))
    chosen = stored(counted.union(blank))

    rows = docs.select(F.struct("*").alias("row"), *text_key(text_or_empty(f"`{text}`")))
    stay = F.col("blank") | F.col(f"row.`{doc_id}`").eqNullSafe(F.col("first_doc"))
    found = rows.join(hinted(chosen, size), ["k1", "k2"]).where(stay)
    merged = found.where("several").groupBy("k1", "k2").agg(F.first("row").alias("row")).select("row")
    return found.where("NOT several").select("row").union(merged).select("row.*")
