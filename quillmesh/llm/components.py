"""Connected components of a link table, by alternating large-star and small-star steps.

Each step is an aggregation by node (partial before the shuffle) and a join, so a node
with very many links is summed map-side and its join is split by the optimizer; nothing
is collected. The number of steps grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh import scratch


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    near = _both_ways(edges)
    least = near.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("m")).select("of", F.least("of", "m").alias("m"))
    return near.filter("v > u").join(least, F.col("u") == F.col("of")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("m"))
    moved = down.join(least, F.col("u") == F.col("of")).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select(F.col("of").alias("u"), F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node of the links (u, v) except the roots."""
    edges = scratch.table(edges.filter("u <> v").select("u", "v").distinct(), "links")
    mark = None
    while True:
        edges = scratch.table(_small_star(_large_star(edges)).filter("u <> v").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = tuple(now)
