"""Merge description rows and select those to publish."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.names import is_pushable, last_segment

_TABLE = ["schema", "table"]
#: A table of more rows is dealt over several tasks. Only the largest tables are, so that their list stays small.
LARGE_ROWS = 1000
LARGE_TABLES = 4096


def join_tables(
    rows: DataFrame, tables: DataFrame, how: str, large_rows: int = LARGE_ROWS, large_tables: int = LARGE_TABLES
) -> DataFrame:
    """``rows`` joined with ``tables``, which has a row per table; ``how`` is ``inner`` or ``left_anti``.

    Rows of a large table don't meet in one task: they are dealt to shares, and its row in ``tables`` is repeated for each.
    What is dealt depends on the rows alone, so a task that runs again deals them alike. Rows without a schema or table match
    nothing. Both schema and table make the key, also where one of them is the same in all of ``tables``.
    """
    spot = "spot"
    while spot in {c.lower() for c in (*rows.columns, *tables.columns)}:
        spot = f"_{spot}"
    table = F.xxhash64(*_TABLE)
    sizes = rows.groupBy(table.alias("table")).agg(F.count("*").alias("n")).where(F.col("n") > large_rows)
    shares = F.struct("table", F.ceil(F.col("n") / large_rows).alias("shares"))
    large = sizes.orderBy(F.desc("n")).limit(large_tables).agg(F.map_from_entries(F.collect_list(shares))).scalar()
    n_shares = F.coalesce(F.try_element_at(large, table), F.lit(1).cast("long"))

    hashed = [F.col(f"`{c}`") for c, kind in rows.dtypes if "map<" not in kind and "variant" not in kind]
    dealt = F.xxhash64(*hashed, F.spark_partition_id())  # rows that are equal in all are dealt by where they stand
    unnamed = F.col("schema").isNull() | F.col("table").isNull()
    share = F.when(unnamed, dealt).otherwise(F.pmod(dealt, n_shares))
    left = rows.withColumn(spot, table.bitwiseXOR(share))
    right = tables.withColumn(spot, F.explode(F.sequence(F.lit(0).cast("long"), n_shares - 1)))
    right = right.withColumn(spot, table.bitwiseXOR(F.col(spot)))
    names = rows.columns if how == "left_anti" else [*rows.columns, *(c for c in tables.columns if c not in _TABLE)]
    return left.join(right, [*_TABLE, spot], how).select(*[F.col(f"`{c}`") for c in names])


def merge_descriptions(stored: DataFrame, now: DataFrame, replaced: DataFrame | None = None) -> DataFrame:
    """Tables in ``now`` replace their stored rows whole; all other stored rows stay.

    Only table names are matched, so a table with many rows on either side neither multiplies nor gathers them. How the
    names travel is left to Spark, which knows their size at run time. ``replaced`` may name the tables when they are known
    more cheaply.
    """
    names = (now if replaced is None else replaced).select(*_TABLE).distinct()
    return join_tables(stored, names, "left_anti").unionByName(now)


def publishable(descriptions: DataFrame) -> DataFrame:
    """The change set to write to a database: non-empty descriptions that are not error messages."""
    return descriptions.where(is_pushable(F.col("description"))).withColumn("table", last_segment(F.col("table")))
