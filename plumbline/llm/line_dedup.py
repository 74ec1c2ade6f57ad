"""Removal of repeated and nearly repeated lines by a deletion-neighbourhood join.

Two lines within one edit of each other become equal when one character is deleted from the longer, or from both at the
same place. So each line gives out the hashes of all its variants with one character less, equal variants are joined,
the edit distance of what meets is verified, and the earliest line stays.

Different lines are collapsed first, with the place of their first occurrence. A line that shares neither its first nor
its last half with another line of fitting length has no partner within one edit; only the others, usually few, give out
variants. Groups of equal variants are reduced to their earliest member, so no pairs within a group are made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import bounded_batches, hinted, stored, text_key, text_or_empty, without

SHORTEST_NEAR = 20  # characters; a shorter line is compared exactly
BLANKS = " \t\r\x0b\x0c"
ADDED = ["n_lines", "n_removed"]
PLACE = ["no_id", "doc_id", "row_key", "line_no"]

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def variant_hashes(line: str) -> tuple[np.ndarray, int]:
    """The hash of the line without its i-th character for every i, and the hash of the whole line.

    The hash is a polynomial in a number that has an inverse, so that all variants together take linear time.
    """
    codes = np.frombuffer(line.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(codes), BASE)]), dtype=np.uint64)
    terms = _mixed(codes + np.uint64(1)) * powers[:-1]
    sums = np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)])
    without_one = sums[:-1] + (sums[-1] - sums[1:]) * INVERSE
    whole = _mixed(sums[-1:] ^ powers[-1:])[0]
    return _mixed(without_one ^ powers[-2]).view(np.int64), int(whole.view(np.int64))


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of survivors to rows of variants: hash, deleted position (-1: none), line and place."""
    for batch in batches:
        columns = batch.to_pydict()
        names = ["k1", "k2", *PLACE]
        for i, line in enumerate(columns["line"]):
            hashes, whole = variant_hashes(line)
            n = len(hashes)
            # With a common first half the edit is in the last one, and the other way round.
            low = 0 if columns["by_end"][i] else (n - 1) // 2
            high = n if columns["by_start"][i] else n // 2 + 1
            at = np.arange(low, high)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.append(hashes[low:high], whole)), pa.array(np.append(at, -1), pa.int32()),
                    *[pa.array([columns[c][i]] * (len(at) + 1), batch.schema.field(c).type) for c in names],
                ],
                ["variant", "position", *names],
            )


def _halves() -> Column:
    """Keys of the first and last halves of ``line``, for partners as long or one shorter and for those one longer."""
    keys = []
    for longer in (0, 1):
        size = F.col("n") + longer
        half = ((size - 1) / 2).cast("int")
        keys.append(F.xxhash64(F.lit("start"), size, F.substr("line", F.lit(1), half)))
        keys.append(F.xxhash64(F.lit("end"), size, F.substr("line", F.col("n") - half + 1, half)))
    return F.array(*keys)


def _lines(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Every line that isn't blank, with its key and place."""
    lines = docs.select(
        F.col(f"`{doc_id}`").isNull().alias("no_id"), F.col(f"`{doc_id}`").alias("doc_id"),
        F.xxhash64(F.col(f"`{doc_id}`").cast("string"), text_or_empty(f"`{text}`")).alias("row_key"),
        F.posexplode(F.split(text_or_empty(f"`{text}`"), "\n", -1)).alias("line_no", "line"),
    )
    trimmed = lines.withColumn("line", F.btrim("line", F.lit(BLANKS))).where("line <> ''")
    return trimmed.select(*text_key(F.col("line")), *PLACE, "line", F.length("line").alias("n"))


def _survivors(lines: DataFrame, different: DataFrame) -> DataFrame:
    """Lines that share a half with another one: their text, place, and whether they share a start or an end."""
    halves = different.where(F.col("halves").isNotNull()).select("k1", "k2", F.posexplode("halves").alias("i", "half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("c")).where("c > 1").select("half")
    found = (
        halves.join(shared, "half")
        .groupBy("k1", "k2")
        .agg(F.max(F.col("i") % 2 == 0).alias("by_start"), F.max(F.col("i") % 2 == 1).alias("by_end"))
    )
    keys = stored(found)
    # Keys of 16 bytes and two flags, so that a count is a size.
    texts = lines.select("k1", "k2", "line").join(hinted(keys, keys.count() * 18), ["k1", "k2"])
    once = texts.groupBy("k1", "k2").agg(F.first("line").alias("line"), F.first("by_start").alias("by_start"), F.first("by_end").alias("by_end"))
    return stored(once.join(different.select("k1", "k2", *PLACE), ["k1", "k2"]))


def near_repeats(survivors: DataFrame) -> DataFrame:
    """``k1, k2`` of lines that are within one edit of an earlier one."""
    schema = "variant long, position int, k1 long, k2 long, no_id boolean, doc_id {}, row_key long, line_no int"
    variants = survivors.mapInArrow(_variants, schema.format(survivors.schema["doc_id"].dataType.simpleString()))
    # Most variants stand alone and go before any further shuffle.
    shared = variants.groupBy("variant").agg(F.count("*").alias("c")).where("c > 1").select("variant")
    variants = stored(variants.join(shared, "variant").select("variant", "position", F.struct(*PLACE, "k1", "k2").alias("it")))
    shorter = variants.where("position >= 0")
    # The same place deleted: all members of a group are one substitution apart, the earliest stands for them.
    first = shorter.groupBy("variant", "position").agg(F.min("it").alias("other"), F.count("*").alias("c")).where("c > 1")
    replaced = shorter.join(first.drop("c"), ["variant", "position"])
    # One line is a variant of the other.
    whole = variants.where("position < 0").select("variant", F.col("it").alias("other"))
    inserted = shorter.drop("position").join(whole, "variant")
    pairs = replaced.select("it", "other").union(inserted.select("it", "other")).where("it <> other")
    pairs = pairs.select(F.greatest("it", "other").alias("late"), F.least("it", "other").alias("early"))
    pairs = pairs.select("late.k1", "late.k2", F.col("early.k1").alias("e1"), F.col("early.k2").alias("e2")).distinct()
    late = survivors.select("k1", "k2", "line")
    early = survivors.select(F.col("k1").alias("e1"), F.col("k2").alias("e2"), F.col("line").alias("other"))
    verified = pairs.join(late, ["k1", "k2"]).join(early, ["e1", "e2"]).where(F.levenshtein("line", "other", 1) >= 0)
    return verified.select("k1", "k2").distinct()


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Every row of ``docs`` with repeated lines taken out of ``text``, ``n_lines`` and ``n_removed``.

    Lines are compared without white space at their ends. A line goes if an equal line, or for lines of 20 characters and
    more one within one edit (a character replaced, inserted or deleted), stands earlier in the table: in a document of
    smaller ``doc_id`` (nulls last, those by a hash of their text), or further up in the same one. Lines are judged on the
    input, not on what is left. Blank lines stay and don't count. Rows equal in id and text are at one place: they lose the
    same lines. A null text stays null, an empty one empty. Columns called ``n_lines`` or ``n_removed`` are replaced; all others stay,
    whatever their names, and ``text`` is found by the session's case rule.
    """
    bounded_batches(docs.sparkSession)
    kept_columns = without(docs, ADDED).columns
    lines = _lines(docs, text, doc_id)
    near = F.when(F.col("n") >= SHORTEST_NEAR, _halves())
    first = lines.select("k1", "k2", F.struct(*PLACE).alias("place"), near.alias("halves")).groupBy("k1", "k2")
    different = first.agg(F.min("place").alias("place"), F.first("halves").alias("halves"))
    different = stored(different.select("k1", "k2", "place.*", "halves"))
    repeats = near_repeats(_survivors(lines, different))
    kept = different.join(repeats, ["k1", "k2"], "left_anti").groupBy("row_key").agg(F.sort_array(F.collect_list("line_no")).alias("kept"))

    @F.pandas_udf("text string, n_lines long, n_removed long")
    def filtered(texts: pd.Series, kept: pd.Series) -> pd.DataFrame:
        rows = []
        for body, numbers in zip(texts, kept, strict=True):
            if body is None:
                rows.append((None, 0, 0))
                continue
            stay, n, out = set() if numbers is None else set(numbers.tolist()), 0, []
            for i, line in enumerate(body.split("\n")):
                blank = not line.strip(BLANKS)
                n += not blank
                if blank or i in stay:
                    out.append(line)
            rows.append(("\n".join(out), n, n - len(stay)))
        return pd.DataFrame(rows, columns=["text", "n_lines", "n_removed"])

    # The row's own columns stand in a struct, away from the names used here.
    body = F.col(f"`{text}`")
    key = F.xxhash64(F.col(f"`{doc_id}`").cast("string"), text_or_empty(body)).alias("row_key")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept_columns]).alias("row"), body.alias("body"), key)
    # Not to be worked out a second time where a caller filters by its numbers.
    once = filtered.asNondeterministic()
    found = whole.join(kept, "row_key", "left").select("row", once("body", "kept").alias("f"))
    case_sensitive = docs.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    replaced = [c for c in kept_columns if c == text or (not case_sensitive and c.lower() == text.lower())]
    return found.select(*[F.col("f.text" if c in replaced else f"row.`{c}`").alias(c) for c in kept_columns], "f.n_lines", "f.n_removed")
