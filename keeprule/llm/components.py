"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keeprule.llm.common import stored


def _ordered(edges: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller end, each once."""
    ends = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return ends.where(F.col("a") != F.col("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return _ordered(both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return _ordered(moved.unionByName(least.select("a", F.col("least").alias("b"))))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the least node it is connected with, for all nodes of edges (a, b) but the least.

    Stars are contracted in turn at the larger and the smaller neighbours until nothing changes; the number of rounds
    grows with the logarithm of the number of nodes. Each round is written to the shared folder. A node's edges are
    only summed and joined with its least neighbour, never gathered.
    """
    now, before = stored(_ordered(edges), "edges"), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = state
        now = stored(_small_star(_large_star(now)), "edges")
