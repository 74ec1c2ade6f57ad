"""Personal data and the terms that give it away, with DataFrame functions only.

Base spans (email, ip, card, phone) are found by patterns in every whole text. Each different value is a protected
entity. How strongly a term reveals an entity is estimated from the corpus: the pointwise mutual information of the
term and the entity, log2(N n_et / (n_e n_t)), as a share of what there is to know about the entity, -log2(n_e / N).
Here N counts documents, n_t those that hold the term, n_e those that hold the entity, and n_et those that hold both,
wherever in the text. Small counts are smoothed: n_et / n_t is drawn towards n_e / N with the weight s / (n_et^2 + s), so that
one meeting in a large corpus counts for something and one in a small corpus for little. Entities of a single document are
judged like all others. Where the share reaches a threshold, all occurrences of the term in texts that hold the entity become
spans of their own, save those in base spans: above the lower threshold they are generalised, above the upper one removed.

Entities that stand in the same texts are one class: their counts are equal with every term. Most entities stand in a
single text, and there n_et is n_e, so nothing need be counted together. For the rest, a bound on n_t that no disclosing
term exceeds, as n_et is at most n_e, keeps frequent words out of the pairs; it loses none.

Documents without base spans have no entity to protect and stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import hinted, stored, text_key, text_or_empty, without

# The contract's patterns. Possessive repeats and the guards in front of them match the same spans; they
# keep the search linear and free of recursion on very long texts.
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
TERM = "term"
TERM_PATTERN = r"\p{L}+"
SHORTEST_TERM = 3
SMOOTHING = 6  # at this many meetings squared, a term's share of an entity and the entity's own share weigh the same
GENERALISE, REMOVE = 0.6, 0.9
BLOCK = 64
PLACEHOLDERS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
SPAN = "struct<start:bigint,rank:int,end:bigint,kind:string,value:string,action:string>"
ADDED = [*(f"n_{k}" for k in KINDS), "base_spans", "spans", "clean_text"]


def _digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


def _passes(kind: str, m: str) -> str:
    """SQL that says whether the match ``m`` counts."""
    if kind == "ip":
        part = "ltrim('0', p)"
        return f"NOT exists(split({m}, '[.]'), p -> length({part}) > 3 OR coalesce(try_cast({part} AS int), 0) > 255)"
    if kind == "phone":
        return f"length({_digits(m)}) BETWEEN 10 AND 15"
    if kind == "card":
        digit = "(ascii(substr(d, length(d) - i, 1)) - 48)"
        double = f"{digit} * 2 - IF({digit} > 4, 9, 0)"
        luhn = f"aggregate(sequence(0, length(d) - 1), 0, (a, i) -> a + IF(i % 2 = 1, {double}, {digit})) % 10 = 0"
        return _named(_digits(m), "d", f"IF(length(d) BETWEEN 14 AND 19, {luhn}, false)")
    return "true"


def _entity(kind: str, m: str) -> str:
    return f"concat('{kind}:', {f'lower({m})' if kind == 'email' else m if kind == 'ip' else _digits(m)})"


def _named(value: str, name: str, body: str) -> str:
    """SQL for ``body`` with ``name`` for ``value``, worked out once. (A column would be put inside the loops that use it.)"""
    return f"transform(array({value}), {name} -> {body})[0]"


def _find(df: DataFrame, text: str, pattern: str, out: str, needs: str = "") -> DataFrame:
    """``df`` with ``out``, all matches ``m`` in ``text`` with their starts ``at`` in code points.

    A start is the sum of the lengths of all matches before it and of the gaps between; sums run in blocks.
    """
    every = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    if needs:
        every = F.when(F.contains(F.col(text), F.lit(needs)), every).otherwise(F.array().cast("array<string>"))
    df = df.withColumn("__m", every).withColumn("__p", F.when(F.size("__m") > 0, F.split(F.col(text), pattern, -1)))
    sums = f"transform(sequence(0, int((size(u.s) - 1) div {BLOCK})), b -> aggregate(slice(u.s, b * {BLOCK} + 1, {BLOCK}), 0L, (a, x) -> a + x))"
    before = f"aggregate({sums}, array(0L), (a, x) -> array_append(a, element_at(a, -1) + x))"
    inside = f"aggregate(slice(v.s, int(i div {BLOCK}) * {BLOCK} + 1, int(i % {BLOCK})), 0L, (a, x) -> a + x)"
    placed = f"transform(v.m, (x, i) -> struct(x AS m, v.o[int(i div {BLOCK})] + {inside} + v.g[i] AS at))"
    placed = _named(f"struct(u.m AS m, u.g AS g, u.s AS s, {before} AS o)", "v", placed)
    steps = "transform(t.m, (x, i) -> bigint(t.g[i] + length(x)))"
    placed = _named(f"struct(t.m AS m, t.g AS g, {steps} AS s)", "u", placed)
    placed = _named("struct(__m AS m, transform(__p, x -> length(x)) AS g)", "t", placed)
    none = F.array().cast("array<struct<m:string,at:bigint>>")
    return df.withColumn(out, F.when(F.size("__m") > 0, F.expr(placed)).otherwise(none)).drop("__m", "__p")


def _with_base(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``base``: all base spans by start, then kind as listed."""
    for kind in KINDS:
        df = _find(df, text, PATTERNS[kind], f"__{kind}", NEEDS.get(kind, ""))
    parts = []
    for rank, kind in enumerate(KINDS):
        span = (
            f"struct(x.at AS start, {rank} AS rank, x.at + length(x.m) AS end, '{kind}' AS kind, "
            f"{_entity(kind, 'x.m')} AS value, 'remove' AS action)"
        )
        parts.append(f"transform(filter(__{kind}, x -> {_passes(kind, 'x.m')}), x -> {span})")
    base = F.expr(f"array_sort(concat({', '.join(parts)}))").cast(f"array<{SPAN}>")
    return df.withColumn("base", base).drop(*[f"__{k}" for k in KINDS])


def _words(text: str) -> Column:
    """The different terms of a text in lower case."""
    every = F.transform(F.regexp_extract_all(F.col(text), F.lit(TERM_PATTERN), F.lit(0)), F.lower)
    return F.array_distinct(F.filter(every, lambda w: F.length(w) >= SHORTEST_TERM))


def _classes(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``k1, k2, c1, c2, n_e`` of the classes in each text: those that stand in this text only, and the others.

    A class is named by the exclusive or of the keys of its texts; that of a single text has the text's own.
    """
    held = texts.select("k1", "k2", "copies", F.explode(F.expr("array_distinct(transform(base, s -> s.value))")).alias("entity"))
    entities = stored(held.groupBy("entity").agg(
        F.sum("copies").alias("n_e"), F.count("*").alias("texts"), F.bit_xor("k1").alias("c1"), F.bit_xor("k2").alias("c2")
    ))
    single = entities.where("texts = 1").select(F.col("c1").alias("k1"), F.col("c2").alias("k2"), "c1", "c2", "n_e").distinct()
    several = entities.where("texts > 1").drop("texts")
    size = several.select(F.sum(F.octet_length("entity") + 40)).first()[0] or 0
    shared = held.drop("copies").join(hinted(several, size), "entity").select("k1", "k2", "c1", "c2", "n_e").distinct()
    return stored(single), stored(shared)


def disclosing_terms(
    texts: DataFrame, docs: DataFrame, text: str, smoothing: float, generalise: float, remove: float
) -> DataFrame:
    """``k1, k2, term, action`` of the terms that reveal an entity of the text, counted over all documents."""
    n = float(max(docs.count(), 1))
    rate = F.col("n_e") / F.lit(n)

    def weight(count: str) -> Column:
        return F.col(count) * F.col(count) / (F.col(count) * F.col(count) + F.lit(float(smoothing)))

    # The most documents a term may stand in to reach the lower threshold; a little more for rounding.
    least = F.pow(rate, F.lit(1.0 - generalise)) - (1 - weight("n_e")) * rate
    bound = F.when(least > 0, F.least(F.lit(n), weight("n_e") * F.col("n_e") / F.nullif(least, F.lit(0.0)) * 1.000001)).otherwise(n)
    single, shared = [c.where(F.col("n_e") < n).withColumn("bound", bound) for c in _classes(texts)]
    most = stored(single.select("k1", "k2", "bound").union(shared.select("k1", "k2", "bound")).groupBy("k1", "k2").agg(F.max("bound").alias("bound")))
    top = most.agg(F.max("bound")).first()[0] or 0.0

    counts = stored(docs.select(F.explode(_words(text)).alias("term")).groupBy("term").agg(F.count("*").alias("n_t")))
    frequent = counts.where(F.col("n_t") > top).select("term")
    size = frequent.select(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    words = texts.join(most, ["k1", "k2"]).select("k1", "k2", "copies", "bound", F.explode(_words("text")).alias("term"))
    rare = words.join(hinted(frequent, size), "term", "left_anti").join(counts.where(F.col("n_t") <= top), "term")
    rare = stored(rare.where(F.col("n_t") <= F.col("bound")).drop("bound"))

    share = F.log2((weight("n_et") * F.col("n_et") / F.col("n_t") + (1 - weight("n_et")) * rate) / rate) / F.nullif(-F.log2(rate), F.lit(0.0))

    def judged(pairs: DataFrame) -> DataFrame:
        strong = pairs.withColumn("share", share).where(F.col("share") >= generalise)
        return strong.withColumn("action", F.when(F.col("share") >= remove, "remove").otherwise("generalise"))

    fits = F.col("n_t") <= F.col("bound")
    alone = judged(rare.join(single, ["k1", "k2"]).where(fits).withColumn("n_et", F.col("n_e")))
    pairs = stored(rare.join(shared, ["k1", "k2"]).where(fits).select("k1", "k2", "copies", "c1", "c2", "n_e", "term", "n_t"))
    together = pairs.groupBy("c1", "c2", "term").agg(F.sum("copies").alias("n_et"), F.first("n_e").alias("n_e"), F.first("n_t").alias("n_t"))
    flagged = stored(judged(together).select("c1", "c2", "term", "action"))
    size = flagged.select(F.sum(F.octet_length("term") + 48)).first()[0] or 0
    met = pairs.select("k1", "k2", "c1", "c2", "term").join(hinted(flagged, size), ["c1", "c2", "term"])
    # With two entities the stronger action holds: of "generalise" and "remove" the larger word.
    found = alone.select("k1", "k2", "term", "action").union(met.select("k1", "k2", "term", "action"))
    return found.groupBy("k1", "k2", "term").agg(F.max("action").alias("action"))


def _occurrences(texts: DataFrame, flagged: DataFrame) -> DataFrame:
    """``k1, k2, terms``: the spans of all occurrences of a text's flagged terms."""
    held = flagged.select("k1", "k2").distinct()
    found = _find(texts.join(held, ["k1", "k2"]), "text", TERM_PATTERN, "t").select("k1", "k2", F.explode("t").alias("t"))
    at = found.select(
        "k1", "k2", F.lower("t.m").alias("term"), F.col("t.at").alias("start"), (F.col("t.at") + F.length("t.m")).alias("end")
    )
    size = flagged.select(F.sum(F.octet_length("term") + 48)).first()[0] or 0
    marked = at.where(F.length("term") >= SHORTEST_TERM).join(hinted(flagged, size), ["k1", "k2", "term"])
    term = F.struct(
        F.col("start"), F.lit(len(KINDS)).alias("rank"), F.col("end"), F.lit(TERM).alias("kind"), F.col("term").alias("value"), "action"
    ).cast(SPAN)
    return marked.groupBy("k1", "k2").agg(F.collect_list(term).alias("terms"))


def sanitise(
    docs: DataFrame,
    text: str = "text",
    smoothing: float = SMOOTHING,
    generalise: float = GENERALISE,
    remove: float = REMOVE,
) -> DataFrame:
    """Every row of ``docs`` with counts of its base spans, ``base_spans``, ``spans`` and ``clean_text``.

    A span has ``start`` and ``end`` (code points, end exclusive), ``kind``, ``value`` and ``action``; lists are ordered
    by start, then kind as listed, terms last. ``clean_text`` has base spans replaced by placeholders, disclosing terms
    by ``[TERM]`` or nothing; a span that begins inside an earlier one is covered with it. A null or empty text has no
    spans, and a null text stays null. Texts are searched whole. Rows with equal texts count as documents each. Columns of the same names as those added are replaced.
    """
    rows = without(docs, ADDED)
    columns = rows.columns
    packed = rows.select(F.struct("*").alias("row"), text_or_empty(f"`{text}`").alias("text"))
    found = _with_base(packed, "text")

    bare = docs.select(text_or_empty(f"`{text}`").alias("text"))
    holding = _with_base(bare, "text").where(F.size("base") > 0)
    keyed = holding.select(*text_key(F.col("text")), "text", "base").groupBy("k1", "k2")
    texts = stored(keyed.agg(F.first("text").alias("text"), F.first("base").alias("base"), F.count("*").alias("copies")))
    flagged = stored(disclosing_terms(texts, bare, "text", smoothing, generalise, remove))
    terms = _occurrences(texts, flagged)

    joined = found.select("row", "text", "base", *text_key(F.col("text"))).join(terms, ["k1", "k2"], "left")
    spans = F.when(F.col("terms").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "apart")))
    counts = [F.expr(f"bigint(size(filter(base, s -> s.kind = '{k}')))").alias(f"n_{k}") for k in KINDS]
    apart = F.expr("filter(terms, t -> NOT exists(base, o -> o.end > t.start AND o.start < t.end))")
    joined = joined.withColumn("apart", apart).withColumn("spans", spans)
    return joined.select(
        *[F.col(f"row.`{c}`").alias(c) for c in columns], *counts, F.col("base").alias("base_spans"), "spans",
        F.when(F.col(f"row.`{text}`").isNotNull(), _redacted()).alias("clean_text"),
    )


def _redacted() -> Column:
    apart = "filter(base, (s, i) -> NOT exists(slice(base, 1, i), p -> p.end > s.start))"
    covered = f"transform({apart}, s -> struct(s, array_max(transform(filter(base, p -> p.start < s.end AND p.end > s.start), p -> p.end)) AS through))"
    # Terms meet no other span.
    alone = "transform(coalesce(apart, array()), s -> struct(s, s.end AS through))"
    covered = f"array_sort(concat({covered}, {alone}))"
    mark = "CASE " + " ".join(f"WHEN k.s.kind = '{k}' THEN '{v}'" for k, v in PLACEHOLDERS.items())
    mark += " WHEN k.s.action = 'generalise' THEN '[TERM]' ELSE '' END"
    pieces = (
        f"transform(c, (k, i) -> concat(substr(text, int(IF(i = 0, 0, c[i - 1].through) + 1), "
        f"int(greatest(k.s.start - IF(i = 0, 0, c[i - 1].through), 0))), {mark}))"
    )
    tail = "substr(text, int(c[size(c) - 1].through + 1))"
    return F.expr(f"IF(size(spans) = 0, text, transform(array({covered}), c -> concat(array_join({pieces}, ''), {tail}))[0])")


def span_list(spans: str) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
