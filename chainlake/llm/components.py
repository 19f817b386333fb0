"""Connected components of links that no single machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlake.llm.base import dropped, written


def large_star(links: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest of its neighbours and itself."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return (
        both.join(least, "a").where("b > a")
        .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
    )


def small_star(links: DataFrame) -> DataFrame:
    """Link each node's smaller neighbours, and itself, to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of ``links`` (``a, b``
    of type long) but the smallest of each component.

    Large and small stars alternate until nothing moves; the number of rounds grows with
    the logarithm of the longest path. A node with many neighbours is one row of a
    grouping that combines before it shuffles, and a skewed join that Spark splits.
    """
    now = written(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == seen or state["n"] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = state
        before, now = now, written(small_star(large_star(now)), "links")
        dropped(before)
