"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (smallest node reachable) of every node with an edge.

    Alternating large-star and small-star steps: every node hands its larger,
    then its smaller, neighbours to the smallest node it knows, until the edges
    are stars.  Each step sums map-side and joins by node, so a node with very
    many neighbours is one row a task in the sums and a splittable key in the
    joins.  Every round is written to the shared folder; rounds grow with the
    logarithm of the longest path.
    """
    links = stage(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
                  .where(F.col("a") != F.col("b")).distinct(), "links")
    seen = None
    while True:  # every round that changes the links brings some node nearer to its smallest one
        links = stage(_small_star(_large_star(links)), "stars")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return (links.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(links.select("b", "b").distinct()))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.join(least, "a").where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()
