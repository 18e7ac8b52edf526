"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctrflow.scratch import discard, materialize


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large(edges: DataFrame) -> DataFrame:
    """Ties all larger neighbours of a node to its least neighbour."""
    near = _both(edges)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    return near.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """Ties a node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    tied = down.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return tied.union(least.select("a", F.col("low").alias("b"))).where("a <> b")


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; a component is named by its least node.

    Alternates large-star and small-star until the edges form stars; the number of edges never grows, and each
    round is written down. Edges from a node to itself and repeated ones do no harm.
    """
    now = materialize(edges.where("a <> b").select("a", "b").distinct(), "edges")

    def state(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()

    seen = state(now)
    while seen[0]:
        before, now = now, materialize(_small(_large(now).distinct()).distinct(), "edges")
        discard(before)
        after = state(now)
        if after == seen:
            break
        seen = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b"), F.col("b")).distinct()
    )
