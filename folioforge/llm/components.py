"""Connected components by alternating large and small stars, all in DataFrames.

Links are pairs of longs. Each round keeps only links to smaller values, every
table of a round lies in the shared folder, and one row at most reaches the
driver: a node that shows that the links are no stars yet (see _unfinished).
Links that are stars from the start take no round. Minima are taken by
partial aggregation and links meet the minimum of their node in joins that deal
the links of a node to many parts, so a node with very many links costs no
single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, saved, spread_join


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return spread_join(both.where("b > a"), low, ["a"], "b").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """links: b < a."""
    low = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = spread_join(links, low, ["a"], "b").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _unfinished(links: DataFrame) -> bool:
    """Whether a node has two smaller ones, or a smaller one and a larger one; links: b < a, without repeats. If not, each class is a star around its least node."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(links.select(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    return bool(ends.groupBy("node").agg((F.sum("down") + F.max("up")).alias("n"), F.max("down").alias("down")).where("n > 1 AND down > 0").head(1))


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest value that each linked node reaches; links has columns a and b, in any order."""
    now = saved(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while _unfinished(now):
        grown = saved(_large_star(now), "links")
        after = saved(_small_star(grown), "links")
        forget(now)
        forget(grown)
        now = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
