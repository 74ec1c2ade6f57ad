"""From raw documents to packed training sequences: five stages, each on all that the one before it kept.

``STAGES`` lists them in order. Each takes the session, the documents so far and the folder with the tables, and returns a
DataFrame; all but the last return the columns of ``documents``. ``run`` writes each stage's rows to the shared folder and
reads them again, so that a lost executor costs one stage at most.

Missing ids, null and empty texts are handled as the operators say. Here a null text goes at the first stage, and the
third leaves one row of each group, also where ids are missing or repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import stored
from plumbline.llm.decontaminate import decontaminate
from plumbline.llm.language_id import UNDETERMINED, identify_languages
from plumbline.llm.line_dedup import dedup_lines
from plumbline.llm.near_dedup import one_of_each
from plumbline.llm.packing import pack_documents
from plumbline.llm.queries import learned, word_count

#: Cosine below which a text resembles no language; a few clean words reach it.
LEAST_SCORE = 0.05


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters and those that resemble no learned language."""
    found = identify_languages(docs, learned(docs))
    return found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_SCORE)).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated lines out; a document that loses all its lines goes."""
    found = dedup_lines(docs).where("n_lines = 0 OR n_removed < n_lines")
    return found.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs, benchmark).where("NOT contaminated").select(docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its place in a sequence; lengths are words."""
    return pack_documents(docs.select("doc_id", word_count("text").alias("n_words")), "n_words")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Several stages have no SQL form; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
