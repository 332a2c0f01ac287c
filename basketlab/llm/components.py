"""Connected components of a large graph: alternating star contraction on DataFrames.

Links are rewired towards the smallest neighbour until every component is one star. Only
minima per node are aggregated (partial sums before the shuffle) and every round is a
written table, so no component ever sits in one task or on the driver and a lost
executor costs one round at most. The table of the round before is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlab.operators.staging import stage, unstage

MAX_ROUNDS = 60


def _both_ways(links: DataFrame) -> DataFrame:
    turned = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return links.unionByName(turned)


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    near = _both_ways(links)
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = near.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in the links (a, b); component is its smallest node.

    Links of a node with itself, repeated and reversed links change nothing; links with
    a null end are left out. No links give no rows.
    """
    current = stage(links.select("a", "b").filter("a <> b").distinct(), "links")
    marks = None
    for _ in range(MAX_ROUNDS):
        before, current = current, stage(_small_star(_large_star(current)), "star_links")
        unstage(before)
        seen = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == marks:
            break
        marks = tuple(seen)
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    members = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
