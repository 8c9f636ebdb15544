"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a grouped minimum and a join on the node, so a node with a third of all edges is
pre-aggregated before the shuffle and its join rows can be split by the adaptive planner.
Each round is written to the shared folder; rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import done, stage


def _least(both: DataFrame) -> DataFrame:
    """Each node's smallest neighbour, itself included."""
    return (both.groupBy("u").agg(F.min("v").alias("m"))
            .select("u", F.least("u", "m").alias("m")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    return (both.join(_least(both), "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (u, v); component is its smallest node.

    Empty edges give an empty result; loops and repeated edges change nothing.
    """
    now = stage(edges.where("u != v").select(F.greatest("u", "v").alias("u"),
                                             F.least("u", "v").alias("v")).distinct(), "cc")
    mark = None
    while True:
        new = stage(_small_star(_large_star(now)), "cc")
        done(now.sparkSession, now)
        seen = new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        now = new
        if seen == mark or not seen[0]:
            break
        mark = seen
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select(F.col("v").alias("node"), F.col("v").alias("component")))
