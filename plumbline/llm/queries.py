"""Registered queries of this package and, where SQL can express them, their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import (
    cross_tokens,
    decontaminate,
    html_text,
    language_id,
    line_dedup,
    near_dedup,
    neighbours,
    packing,
    pii,
    ranked_search,
    sharding,
    suffix_dedup,
    token_counts,
)
from plumbline.llm.common import SPACES, text_or_empty

SHARDS = 8
NEIGHBOURS = 20
QUERY_EVERY = 20
BEST = 10
NEAR_PERCENT = near_dedup.PERCENT
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _crc(text):
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.decontaminate(docs, _read(spark, sf_dir, "benchmark")).drop("text")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_read(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_byte_range_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = text_or_empty()
    docs = _read(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), _crc(text).alias("text_crc32")
    )
    sharded = sharding.assign_shards(docs, SHARDS, size="size", order=["doc_id", "text_crc32", "size"])
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op4_disclosure_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.sanitise(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", *[f"n_{k}" for k in pii.KINDS], F.sha2(pii.span_list("base_spans"), 256).alias("base_sha256"),
        pii.span_list("spans").alias("spans"),
    )


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = neighbours.usable_vectors(_read(spark, sf_dir, "embeddings"))
    return neighbours.nearest_neighbours(vectors.where(F.col("vec_id") % QUERY_EVERY == 0), vectors, NEIGHBOURS)


def op6_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_read(spark, sf_dir, "documents").select("doc_id", "text"), shingle=2).drop("text")


def word_count(text):
    """Words between ASCII white space; 0 for a null text."""
    return F.size(F.filter(F.split(text_or_empty(text), SPACES), lambda w: w != ""))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", word_count("text").alias("n_words"))
    return packing.pack_documents(docs, "n_words")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, token_counts.read_pieces(PIECES))
    return counted.select("doc_id", F.octet_length(text_or_empty()).cast("long").alias("n_bytes"), "n_tokens")


def held_out(doc_id):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learned(docs: DataFrame) -> language_id.Profiles:
    return language_id.learn(docs.where(F.col("doc_id").isNotNull() & ~held_out("doc_id")))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    found = language_id.identify_languages(docs.select("doc_id", "text"), learned(docs))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return cross_tokens.align_tokens(docs, BYTE_LEVEL, PIECES, digest=True).withColumnRenamed("groups", "groups_sha256")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), BEST)


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(_read(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_decontamination, op2_line_dedup, op3_byte_range_shards, op4_disclosure_pii, op5_nearest_neighbours, op6_minmax_near_dedup, op7_best_fit_packing, op8_suffix_dedup, op9_token_counts, op10_language_id, op11_token_alignment, op12_ranked_search, op13_main_text)
}

SQL: dict[str, str] = {}

SQL["op5_nearest_neighbours"] = f"""
WITH usable AS (
  SELECT vec_id, min(embedding::DOUBLE[]) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0
  GROUP BY vec_id
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % {QUERY_EVERY} = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM scored
)
SELECT query_id, n::INTEGER AS rank, vec_id, score FROM ranked WHERE n <= {NEIGHBOURS}
"""

SQL["op2_line_dedup"] = f"""
WITH parts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS p FROM documents),
raw AS (SELECT doc_id, unnest(p) AS part, generate_subscripts(p, 1) AS line_no FROM parts),
lines AS (SELECT *, trim(part, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line FROM raw),
different AS (
  SELECT line, length(line) AS n, min(doc_id::HUGEINT * 4294967296 + line_no) AS place FROM lines WHERE line <> '' GROUP BY line
), halves AS (
  SELECT line, n, place, unnest([
    'a' || n || left(line, (n - 1) // 2), 'z' || n || right(line, (n - 1) // 2),
    'a' || (n + 1) || left(line, n // 2), 'z' || (n + 1) || right(line, n // 2)]) AS half
  FROM different WHERE n >= {line_dedup.SHORTEST_NEAR}
), pairs AS (
  SELECT DISTINCT b.line AS late, CASE WHEN a.n > b.n THEN a.line ELSE b.line END AS long,
         CASE WHEN a.n > b.n THEN b.line ELSE a.line END AS short
  FROM halves a JOIN halves b ON a.half = b.half AND a.place < b.place
), near AS (
  SELECT DISTINCT late FROM pairs WHERE len(list_filter(range(1, length(long) + 1), lambda i:
    left(long, i - 1) = left(short, i - 1)
    AND substr(long, i + 1) = substr(short, i + 1 - length(long) + length(short)))) > 0
), judged AS (
  SELECT doc_id, line_no, part, line <> '' AS counts,
         line = '' OR (line NOT IN (SELECT late FROM near) AND doc_id::HUGEINT * 4294967296 + line_no = place) AS stays
  FROM lines LEFT JOIN different USING (line)
), left_over AS (
  SELECT doc_id, coalesce(string_agg(part, chr(10) ORDER BY line_no) FILTER (WHERE stays), '') AS text,
         count(*) FILTER (WHERE counts) AS n_lines, count(*) FILTER (WHERE NOT stays) AS n_removed
  FROM judged GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN l.text END AS text, n_lines, n_removed
FROM documents d JOIN left_over l USING (doc_id)
"""

SQL["op6_minmax_near_dedup"] = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words
), grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {NEAR_PERCENT} * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least USING (doc_id)
"""

SQL["op12_ranked_search"] = f"""
WITH terms AS (
  SELECT *, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), lambda t: t <> '') AS t
  FROM (SELECT 'd' AS side, row_number() OVER () AS no, doc_id AS id, text FROM documents
        UNION ALL SELECT 'i', row_number() OVER (), item_id, text FROM benchmark)
), corpus AS (SELECT count(*)::BIGINT AS n_docs, sum(len(t))::BIGINT AS n_terms FROM terms WHERE side = 'd' AND len(t) > 0),
counts AS (SELECT side, no, id, len(t) AS n, unnest(t) AS term FROM terms),
tf AS (SELECT side, no, id, n, term, count(*) AS tf FROM counts GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, corpus WHERE side = 'd' GROUP BY term
), scored AS (
  SELECT i.no AS item, i.id AS item_id, d.id AS doc_id, sum(i.tf * w
    * ((1000000000 * d.tf) // (1000 * d.tf + 8 * (25 + (75 * d.n * n_docs) // n_terms))))::BIGINT AS score
  FROM tf i JOIN tf d ON i.term = d.term AND i.side = 'i' AND d.side = 'd' JOIN weights ON weights.term = i.term, corpus
  GROUP BY i.no, i.id, d.no, d.id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS n FROM scored WHERE score > 0
)
SELECT item_id, n::INTEGER AS rank, doc_id, score FROM ranked WHERE n <= {BEST}
"""

# CRC32 by its table of 256 entries, worked out here from its polynomial.
SQL["op3_byte_range_shards"] = f"""
WITH crc AS (
  SELECT list_transform(range(0, 256), lambda n: list_reduce(range(0, 8),
    lambda a, k: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END, n)) AS t
), bytes AS (
  SELECT doc_id, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
    lambda h: ((strpos('123456789ABCDEF', h[1])) * 16 + strpos('123456789ABCDEF', h[2]))::BIGINT) AS b FROM documents
), sized AS (
  SELECT doc_id, len(b) + 1 AS size, xor(4294967295, list_reduce(b,
    lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]), 4294967295)) AS text_crc32 FROM bytes, crc
), placed AS (
  SELECT *, least((sum(size) OVER (ORDER BY doc_id, text_crc32, size ROWS UNBOUNDED PRECEDING) - size) * {SHARDS} // sum(size) OVER (), {SHARDS - 1})::INTEGER AS shard
  FROM sized
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot, NULL::INTEGER AS grown_shard FROM placed
"""

# Every string of the length, in hexadecimal digits; covered bytes are cut out run by run.
SQL["op8_suffix_dedup"] = f"""
WITH texts AS (SELECT row_number() OVER () AS no, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
strings AS (
  SELECT no, p, hash(substr(x, 2 * p + 1, {2 * suffix_dedup.MIN_BYTES})) AS h
  FROM (SELECT no, x, unnest(range(0, len(x) // 2 - {suffix_dedup.MIN_BYTES - 1})) AS p FROM texts WHERE len(x) >= {2 * suffix_dedup.MIN_BYTES})
), repeated AS (SELECT no, p FROM strings QUALIFY count(*) OVER (PARTITION BY h) > 1),
edges AS (SELECT no, p, coalesce(p - lag(p) OVER (PARTITION BY no ORDER BY p) > {suffix_dedup.MIN_BYTES}, true) AS opens FROM repeated),
numbered AS (SELECT no, p, sum(opens::INTEGER) OVER (PARTITION BY no ORDER BY p) AS run FROM edges),
runs AS (SELECT no, run, min(p) AS s, max(p) + {suffix_dedup.MIN_BYTES} AS e FROM numbered GROUP BY no, run),
gaps AS (SELECT no, run, s, e, coalesce(lag(e) OVER (PARTITION BY no ORDER BY run), 0) AS z FROM runs),
cut AS (
  SELECT no, sum(e - s) AS n_removed, count(*) AS n_spans, max(e) AS through,
         string_agg(substr(x, 2 * z + 1, 2 * (s - z)), '' ORDER BY run) AS kept
  FROM gaps JOIN texts USING (no) GROUP BY no
)
SELECT doc_id, (len(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept || substr(x, 2 * through + 1), x))) AS kept_sha256
FROM texts LEFT JOIN cut USING (no)
"""
