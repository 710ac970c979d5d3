"""Connected components of an edge table, by alternating large-star and small-star
steps (Kiveris et al., 2014). Every step is a grouped minimum and a join on one
column, so a vertex with very many neighbours costs one row per neighbour and its
minimum is taken map-side first. Each round is written, which cuts the lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.llm._common import written

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``a, b``: every vertex of ``edges`` (columns ``a, b``) other than the least
    of its component, with that least vertex."""
    edges = written(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), "links")
    before = None
    for _ in range(MAX_ROUNDS):
        edges = written(_small_star(_large_star(edges)).where("a != b").distinct(), "links")
        # A star forest is a fixed point of both steps.
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now == before:
            return edges
        before = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
