"""Connected components over an edge table, by alternating large-star and small-star steps.

Each step is a grouped minimum (partial aggregation, so a hub that a third of all edges touch is reduced in every task)
and an equi-join whose hot keys adaptive execution may split. The edges of each round are written to the shared
scratch folder: a lost executor costs one round at most, and nothing but two counts reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strata.llm.common import forget, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large-star links every larger neighbour of a node, small-star every smaller one and the node itself, to the
    smallest member of its neighbourhood."""
    if large:
        near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        out = near.join(least, "a").where(F.col("b") > F.col("a")).select(
            F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = near.groupBy("a").agg(F.min("b").alias("least"))
        out = near.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); ``root`` is the smallest node of its component."""
    now = written(edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        before, now = now, written(_star(_star(now, True), False), "edges")
        forget(before)
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
