"""Contiguous shards of near equal byte size.

Rows are put in global order by a range shuffle, each partition's bytes and rows are totalled, the totals are
summed up over the partitions, and a running sum inside each partition gives every row its first byte. A row
belongs to the shard whose share of all bytes holds that byte. Only totals of partitions, never rows, meet in
one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import partitions_of, stored, without

ADDED = ["shard", "slot"]


def assign_shards(docs: DataFrame, n_shards: int, size: str, order: Sequence[str]) -> DataFrame:
    """Every row of ``docs`` with ``shard`` (0 to ``n_shards - 1``) and ``slot`` (0, 1, ... inside its shard).

    ``size`` names a column of non-negative whole numbers (null counts as 0), ``order`` the columns that order the
    rows, nulls first. Rows equal in ``order`` are put in one fixed order drawn once, so equal keys, however many,
    spread over partitions and shards. Columns of ``docs`` called ``shard`` or ``slot`` are replaced. If all sizes
    are 0, all rows are in shard 0. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    keys = [f"k{i}" for i in range(len(order))] + ["tie"]
    rows = without(docs, ADDED)
    columns = rows.columns
    rows = rows.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col(f"`{size}`").cast("long"), F.lit(0)).alias("bytes"),
        *[F.col(f"`{c}`").alias(k) for c, k in zip(order, keys, strict=False)],
        F.rand(7).alias("tie"),
    )
    ranged = rows.repartitionByRange(partitions_of(spark), *keys)
    placed = stored(ranged.withColumn("part", F.spark_partition_id()))

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    totals = (
        placed.groupBy("part")
        .agg(F.sum("bytes").alias("part_bytes"), F.count("*").alias("part_rows"))
        .select(
            "part",
            F.coalesce(F.sum("part_bytes").over(before), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("rows_before"),
            F.sum("part_bytes").over(every).alias("all_bytes"),
        )
    )
    inside = Window.partitionBy("part").orderBy(*keys)
    running = (
        placed.withColumn("through", F.sum("bytes").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("nth", F.row_number().over(inside))
        .join(totals, "part")
    )
    cut = F.expr(f"cast((bytes_before + through - bytes) * {n_shards} div greatest(all_bytes, 1) as int)")
    sharded = running.select(
        "row",
        F.least(cut, F.lit(n_shards - 1)).alias("shard"),
        (F.col("rows_before") + F.col("nth") - 1).alias("place"),
    )
    # At most n_shards rows: a parameter bounds what is broadcast.
    first = F.broadcast(sharded.groupBy("shard").agg(F.min("place").alias("first_place")))
    return sharded.join(first, "shard").select(
        *[F.col(f"row.`{c}`").alias(c) for c in columns], "shard", (F.col("place") - F.col("first_place")).alias("slot")
    )
