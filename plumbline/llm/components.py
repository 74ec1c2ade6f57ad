"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``id, component`` of every node of ``edges`` (long columns ``a`` and ``b``); a component is named by its least id.

    Each round links all neighbours of a node that are larger than it, then all that are smaller, to the least of them
    (large star and small star), until every node is linked to the least of its component. Rounds grow with the logarithm of
    the nodes; each is written to the shared folder, so that a lost executor costs one round.
    """

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    links = stored(links)
    before = None
    while (now := state(links)) != before:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stored(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        before = now
    roots = links.select(F.col("v").alias("id")).distinct()
    return links.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots.select("id", F.col("id").alias("component")))
