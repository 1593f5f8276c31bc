"""Connected components by alternating star contraction, all of it joins and minima of the edge table."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import staged


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours move to the smallest node around each node."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of the edges ``a, b``; lone nodes are absent.

    Loops and repeated edges are allowed. Each round is written to the shared folder, so that its lineage ends
    there; the number of rounds grows with the logarithm of the longest path.
    """
    now = staged(edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(now)
    while True:
        now = staged(_small_star(_large_star(now)))
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
