"""Connected components of a large edge list, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, root of every node in ``edges`` (columns a and b of one orderable type): the root is the least node of the component.

    Each round keeps at most as many edges as before; rounds grow with the logarithm of the longest path. Only counts come to the driver.
    """
    at = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    at, before = common.cut(at), None
    for _ in range(max_rounds):
        both = at.unionByName(at.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(small, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        at = common.cut(moved.unionByName(small.select("u", F.col("m").alias("v"))).distinct())
        state = at.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")).first()
        if state == before:
            return at.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(at.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
