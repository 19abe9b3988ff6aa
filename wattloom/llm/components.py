"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import stored


def _starred(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: every node links neighbours to the least node it sees.

    A large star moves the neighbours above a node, a small star those below it and the
    node itself. The least neighbour is a partial aggregate and the join back can be
    split by AQE, so a node with a third of all edges is no bottleneck.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    around = both if large else both.filter("v < u")
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    if large:
        moved = around.join(least, "u").filter("v > u").select(F.col("v").alias("x"), "m")
    else:
        moved = around.join(least, "u").select(F.col("v").alias("x"), "m").union(least.select(F.col("u").alias("x"), "m"))
    return moved.filter("x <> m").select(F.col("m").alias("a"), F.col("x").alias("b")).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node with an edge.

    ``edges`` has two columns ``a`` and ``b`` of one orderable type, without NULL. The
    edges shrink to stars around the roots in a number of rounds that grows with the
    logarithm of the longest path; each round is stored, so that a lost executor does
    not repeat earlier ones. Not converging within ``max_rounds`` fails.
    """
    edges = stored(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "component-edges")
    before = None
    for _ in range(max_rounds):
        edges = stored(_starred(_starred(edges, True), False), "component-edges")
        # equal counts and equal hashes summed over all edges: nothing moved
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            stars = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
            return stars.union(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
