"""Connected components of a graph that stays distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger.staging import Staging


def _stars(edges: DataFrame) -> DataFrame:
    """One round: larger neighbours, then smaller ones, are hung on the least of each
    neighbourhood. Minima are partial aggregates, and the joins are plain equi-joins whose hot
    keys adaptive execution splits."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    large = large.distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a")
    moved = small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, staging: Staging) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) of every node with an edge.

    Rounds go on until the edges no longer change; each is written to the shared folder, so a
    lost executor costs one round's tasks.
    """
    now = staging.put(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        found = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(found) == mark or not found[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = tuple(found)
        now = staging.put(_stars(now), "edges")
