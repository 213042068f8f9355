"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailframe.llm.common import scratch_table


def _toward_least(edges: DataFrame, upward: bool) -> DataFrame:
    """Link each node's larger (``upward``) or smaller neighbours to its least neighbour or itself."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both if upward else both.filter("b < a")
    least = near.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    if upward:
        moved = both.filter("b > a").join(least, "a").select(F.col("b").alias("x"), "m")
    else:
        moved = near.join(least, "a").select(F.col("b").alias("x"), "m").union(least.select(F.col("a").alias("x"), "m"))
    return moved.filter("x <> m").select(F.greatest("x", "m").alias("a"), F.least("x", "m").alias("b")).distinct()


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node that has an edge; the root is the least node of its component.

    Every round is written to shared storage. A node of any degree is aggregated before its
    shuffle; the joins on it are plain equi-joins that Spark can split.
    """
    now = scratch_table(edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges")
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if tuple(state) == seen or not state["n"]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b")).distinct()
        seen = tuple(state)
        now = scratch_table(_toward_least(_toward_least(now, True), False), "edges")
