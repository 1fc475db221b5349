"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from finmarts.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the node's smallest neighbour, or to the node if that is smaller."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("m").alias("a"), "b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Links every smaller neighbour of a node, and the node, to the smallest of them."""
    down = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    least = down.groupBy("b").agg(F.min("a").alias("m"))
    others = down.join(least, "b").where(F.col("a") > F.col("m")).select(F.col("m").alias("a"), F.col("a").alias("b"))
    return others.union(least.select(F.col("m").alias("a"), "b"))


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node of the edges (a, b) but the roots.

    Each round joins sums and minima only, never a node's whole neighbourhood, and is written to the shared folder,
    so that neither the plan nor a task grows with the number of rounds. It ends when a round changes nothing.
    """
    current = written(edges.where(F.col("a") != F.col("b")).select("a", "b").distinct(), "edges")
    seen = None
    while True:
        now = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen or now[0] == 0:
            return current.select(F.col("b").alias("node"), F.col("a").alias("root"))
        seen = now
        current = written(_small_star(_large_star(current).distinct()).distinct(), "edges")
