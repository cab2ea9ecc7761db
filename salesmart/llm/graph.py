"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's greater neighbours move to the least node next to it."""
    both = edges.union(edges.select(F.col("b"), F.col("a")).toDF("a", "b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    moved = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b")
    return moved.filter("a < b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its lesser neighbours move to the least of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    joined = edges.join(least, "b")
    moved = joined.select(F.col("m").alias("x"), F.col("a").alias("y")).union(
        least.select(F.col("m").alias("x"), F.col("b").alias("y"))
    )
    return moved.filter("x < y").distinct().toDF("a", "b")


def _has_chains(edges: DataFrame) -> bool:
    """Whether some node is under two others, or under one and over another."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("over"), F.lit(0).alias("under"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1)))
    counted = ends.groupBy("id").agg(F.max("over").alias("over"), F.sum("under").alias("under"))
    return not counted.filter("under > 1 or (over = 1 and under = 1)").isEmpty()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component): every node of an edge with the least node it can reach.

    `edges` has columns a < b of type long. Each round is written to the shared folder, and the
    rounds end when every component is a star around its least node; only that answer comes to
    the driver. A star's centre may have any degree: its neighbours are reduced by partial sums
    and the join back is split by AQE.
    """
    now, path = scratch.staged(edges.select("a", "b").filter("a < b").distinct())
    while _has_chains(now):
        after, new_path = scratch.staged(_small_star(_large_star(now)))
        scratch.drop(path)
        now, path = after, new_path
    members = now.select(F.col("b").alias("id"), F.col("a").alias("component"))
    return members.union(now.select("a", "a").distinct())
