"""Documents that hold a benchmark item, with DataFrame functions only.

Item-sized windows of the documents get SimHash fingerprints of their words. Fingerprints are cut into one block more than
the radius has bits, so two within the radius agree in at least one block: a join on blocks finds all of them. What passes
the exact Hamming distance is verified by the weighted Jaccard similarity of word shingles, counts as weights.

A window of that similarity shares a shingle with the item. So only windows that lay such a shingle over the item's own
are looked at; this loses none and keeps windows from being made at every word. Equal windows are fingerprinted once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import SPACES, hinted, stored, text_key, text_or_empty, without

SHINGLE = 5
PERCENT = 80
BITS = 64
RADIUS = 20
ADDED = ["contaminated", "items", "similarity"]


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), SPACES), lambda w: w != "")


def _grams(words: str, size: int) -> str:
    """SQL for the hashes of all runs of ``size`` words."""
    run = ", ".join(f"{words}[i + {k}]" for k in range(size))
    return f"IF(size({words}) >= {size}, transform(sequence(0, size({words}) - {size}), i -> xxhash64({size}, {run})), array())"


def _shingles(words: str) -> str:
    """Shingles of an item's words or of a window of an item: fewer words than a shingle has are one shingle."""
    short = " ".join(f"WHEN n = {k} THEN {_grams(words, k)}" for k in range(1, SHINGLE))
    return f"CASE {short} ELSE {_grams(words, SHINGLE)} END"


def fingerprint(words: str) -> Column:
    """64-bit SimHash of an array of words, each as often as it occurs."""
    votes = "aggregate(h, 0, (a, x) -> a + IF(shiftright(x, b) & 1 = 1, 1, -1))"
    bits = f"aggregate(sequence(0, {BITS - 1}), 0L, (f, b) -> f | IF({votes} > 0, shiftleft(1L, b), 0L))"
    return F.expr(f"transform(array(transform({words}, w -> xxhash64(w))), h -> {bits})[0]")


def _blocks(print_: str, radius: int) -> Column:
    """Number and bits of each of ``radius + 1`` blocks."""
    edges = [BITS * i // (radius + 1) for i in range(radius + 2)]
    parts = [
        f"struct({i} AS block, shiftrightunsigned({print_}, {a}) & {(1 << (b - a)) - 1}L AS bits)"
        for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))
    ]
    return F.expr(f"inline(array({', '.join(parts)}))")


def _items(benchmark: DataFrame, text: str, item_id: str) -> DataFrame:
    """Different items with words: key, words, number of words and ids."""
    words = benchmark.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), words_of(text_or_empty(f"`{text}`")).alias("words"))
    keyed = words.where(F.size("words") > 0).withColumn("item", F.xxhash64(F.concat_ws(" ", "words")))
    return keyed.groupBy("item").agg(
        F.first("words").alias("words"), F.first(F.size("words")).alias("n"), F.sort_array(F.collect_set("item_id")).alias("ids")
    )


def _windows(texts: DataFrame, items: DataFrame) -> DataFrame:
    """``k1, k2, start, length, n``: windows that lay a shingle over the same one of an item of ``n`` words."""
    sizes = [r[0] for r in items.select(F.least("n", F.lit(SHINGLE)).alias("s")).distinct().collect()]  # at most five
    found = []
    for size in sizes:
        own = items.where(F.col("n") >= SHINGLE if size == SHINGLE else F.col("n") == size)
        places = stored(own.select("n", F.expr(f"posexplode({_grams('words', size)})").alias("at", "gram")).distinct())
        grams = texts.select("k1", "k2", F.size("words").alias("n_words"), F.expr(f"posexplode({_grams('words', size)})").alias("pos", "gram"))
        hits = grams.join(hinted(places, places.count() * 16), "gram")
        length = F.least("n", "n_words")
        start = F.greatest(F.lit(0), F.least(F.col("pos") - F.col("at"), F.col("n_words") - length))
        found.append(hits.select("k1", "k2", start.alias("start"), length.alias("length"), "n"))
    return reduce(DataFrame.union, found).distinct()


def contaminated_texts(
    docs: DataFrame, benchmark: DataFrame, text: str, item_text: str, item_id: str, percent: int, radius: int
) -> DataFrame:
    """``k1, k2, items, similarity`` of the texts that hold an item."""
    body = docs.select(text_or_empty(f"`{text}`").alias("text"))
    keyed = body.select(*text_key(F.col("text")), "text")
    items = stored(_items(benchmark, item_text, item_id))
    if items.isEmpty():
        return items.select(F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"), F.col("ids").alias("items"), F.lit(0.0).alias("similarity")).where("false")
    windows = stored(_windows(keyed.select("k1", "k2", words_of(F.col("text")).alias("words")), items))
    hit = windows.select("k1", "k2").distinct()
    texts = keyed.join(hinted(hit, hit.count() * 16), ["k1", "k2"]).groupBy("k1", "k2").agg(F.first("text").alias("text"))
    cut = F.expr("slice(words, start + 1, length)")
    placed = texts.select("k1", "k2", words_of(F.col("text")).alias("words")).join(windows, ["k1", "k2"]).select("k1", "k2", "n", cut.alias("words"))
    placed = stored(placed.select("k1", "k2", "n", *[k.alias(a) for k, a in zip(text_key(F.concat_ws(" ", "words")), ("w1", "w2"), strict=True)], "words"))
    window = ["w1", "w2", "n"]
    different = placed.groupBy(*window).agg(F.first("words").alias("words"))

    left = different.withColumn("print", fingerprint("words"))
    right = items.select("item", "n", F.col("words").alias("item_words"), fingerprint("words").alias("item_print"))
    blocks = left.select(*window, "print", _blocks("print", radius))
    item_blocks = right.select("item", "n", "item_print", _blocks("item_print", radius))
    near = (
        blocks.join(item_blocks, ["n", "block", "bits"])
        .where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius)
        .select(*window, "item")
        .distinct()
    )
    pair = [*window, "item"]
    of_window = near.join(different, window).select(*pair, F.explode(F.expr(_shingles("words"))).alias("gram"), F.lit(1).alias("a"), F.lit(0).alias("b"))
    of_item = near.join(right, ["item", "n"]).select(*pair, F.explode(F.expr(_shingles("item_words"))).alias("gram"), F.lit(0).alias("a"), F.lit(1).alias("b"))
    counts = of_window.union(of_item).groupBy(*pair, "gram").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    alike = counts.groupBy(*pair).agg(F.sum(F.least("a", "b")).alias("both"), F.sum(F.greatest("a", "b")).alias("any"))
    matches = alike.where(F.col("both") * 100 >= F.col("any") * percent).select(*pair, (F.col("both") / F.col("any")).alias("similarity"))
    held = placed.select("k1", "k2", *window).join(matches, window).join(items.select("item", "ids"), "item")
    # Items without id have no ids here; the text is held against them all the same.
    return held.select("k1", "k2", F.explode_outer("ids").alias("id"), "similarity").groupBy("k1", "k2").agg(
        F.sort_array(F.collect_set("id")).alias("items"), F.max("similarity").alias("similarity")
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_text: str = "text",
    item_id: str = "item_id",
    percent: int = PERCENT,
    radius: int = RADIUS,
) -> DataFrame:
    """Every row of ``docs`` with ``contaminated``, ``items`` (ids of the benchmark items it holds) and ``similarity``.

    A document holds an item if a window as long as the item (or the whole document, if that is shorter) has at least
    ``percent`` per cent of weighted Jaccard similarity with it over shingles of five lower-case words; an item of fewer words
    is one shingle. ``similarity`` is the largest one found, null if there is none, and ``items`` is empty then. Whole texts
    are searched. Null and empty texts hold nothing; items without words are held by nothing; equal items are found
    together, items without id are found but not listed. Repeated rows get equal answers. Columns of the names added are
    replaced. An empty table of either kind gives no match.
    """
    kept = without(docs, ADDED)
    found = stored(contaminated_texts(docs, benchmark, text, item_text, item_id, percent, radius))
    size = found.select(F.sum(F.size("items") * 8 + 48)).first()[0] or 0
    rows = kept.select(F.struct("*").alias("row"), *text_key(text_or_empty(f"`{text}`")))
    joined = rows.join(hinted(found, size), ["k1", "k2"], "left")
    return joined.select(
        *[F.col(f"row.`{c}`").alias(c) for c in kept.columns], F.col("items").isNotNull().alias("contaminated"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"), "similarity",
    )
