"""Connected components of a table of links, by alternating large and small stars. Links and labels never reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import cut


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Per node of any link: node, component (the smallest node reachable). Links are pairs of longs, in any order and number.

    Large star: every larger neighbour of a node is linked to the smallest of its neighbourhood. Small star: every smaller one is. Repeated until
    nothing changes, which takes about the logarithm of the longest path; each round starts from a checkpoint. Minima are combined before their shuffle, and
    the join on a hub's key is one that adaptive execution splits.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        """e: directed rows (u, v), for a large star both directions, for a small one from the larger node to the smaller."""
        least = e.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        joined = e.join(least, "u")
        if large:
            return joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.filter("u <> m").select("u", F.col("m").alias("v")))

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = cut(links.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = star(both, True).distinct()
        edges = cut(star(large, False).distinct())
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
