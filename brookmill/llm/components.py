"""Connected components of a graph of ids, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmill.session import materialise


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node and its neighbours."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    tied = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
    return tied.union(least.select("a", F.col("least").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: the smallest id reachable, for every node of the edges ``a, b`` (BIGINT).

    Loops and repeated edges are of no consequence; null ends are left out. Each round is one
    materialised table; the number of rounds grows with the logarithm of the largest component.
    """
    now = materialise(edges.dropna().where("a <> b").distinct(), "edges")
    state = None
    while True:
        now = materialise(_small(_large(now)), "stars")
        found = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        if found == state:
            break
        state = found
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
