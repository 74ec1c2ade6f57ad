"""Resolve a schema and table name to a DataFrame."""

from __future__ import annotations

import re
from collections.abc import Callable, Hashable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

Tables = Callable[[str, str], DataFrame]
Key = TypeVar("Key", bound=Hashable)
Result = TypeVar("Result")

_MISSING = ("TABLE_OR_VIEW_NOT_FOUND", "PATH_NOT_FOUND", "SCHEMA_NOT_FOUND")


def reraise_if_stopped(spark: SparkSession, error: Exception) -> None:
    """Errors of one table are results; a cancelled job or a lost session is not."""
    context = spark.sparkContext
    stopped = context._jsc is None or context._jsc.sc().isStopped()
    if stopped or re.search(r"SPARK_JOB_CANCELLED|Job \d+ cancelled|cancelled part of cancelled job|SparkContext was shut down", str(error)):
        raise error


def missing_or_reason(error: Exception, name: str) -> str:
    """Why a table could not be opened."""
    condition = error.getCondition() if isinstance(error, PySparkException) else None
    if isinstance(error, KeyError) or condition in _MISSING:
        return f"missing table {name}"
    return str(error).split("\n")[0] or type(error).__name__


def side_by_side(spark: SparkSession, run: Callable[[Key], Result], keys: Iterable[Key], at_once: int) -> dict[Key, Result]:
    """``run`` for every key, several at a time: listing files and small jobs wait on storage."""
    keys = list(keys)
    with ThreadPoolExecutor(max(1, at_once)) as pool:
        return dict(zip(keys, pool.map(inheritable_thread_target(spark)(run), keys), strict=True))


def open_tables(spark: SparkSession, tables: Tables, keys: Iterable[tuple[str, str]], at_once: int = 8) -> dict[tuple[str, str], DataFrame | str]:
    """Each table, or the reason why it can't be opened; an error costs only its own table."""

    def open_table(key: tuple[str, str]) -> DataFrame | str:
        try:
            df = tables(*key)
            df.schema  # noqa: B018  a lazy table fails here if at all
            return df
        except Exception as error:  # isolation boundary
            reraise_if_stopped(spark, error)
            return missing_or_reason(error, ".".join(key))

    return side_by_side(spark, open_table, keys, at_once)


def parquet_tables(spark: SparkSession, pattern: str) -> Tables:
    """Tables at paths such as ``/lake/{schema}/{table}``."""

    def read(schema: str, table: str) -> DataFrame:
        return spark.read.parquet(pattern.format(schema=schema, table=table))

    return read


def quoted_name(schema: str | None, table: str) -> str:
    parts = f"{schema}.{table}".split(".") if schema else [table]
    return ".".join(f"`{part}`" for part in parts)


def catalog_tables(spark: SparkSession) -> Tables:
    """Tables of the session catalog."""
    return lambda schema, table: spark.table(quoted_name(schema, table))


def frames(tables: dict[str, DataFrame]) -> Tables:
    """Prepared DataFrames by full name or by table name alone."""

    def read(schema: str, table: str) -> DataFrame:
        if f"{schema}.{table}" in tables:
            return tables[f"{schema}.{table}"]
        return tables[table]

    return read
