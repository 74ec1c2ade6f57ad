"""A few driver-side rows as literals, read by the JVM alone."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_rows(rows: Iterable[Mapping], schema: str) -> Column:
    """An array of structs; Catalyst folds it to one literal."""
    return F.from_json(F.lit(json.dumps(list(rows))), f"array<struct<{schema}>>")


def local_rows(spark: SparkSession, rows: Iterable[Mapping], schema: str) -> DataFrame:
    return spark.range(0, 1, 1, 1).select(F.inline(literal_rows(rows, schema)))
