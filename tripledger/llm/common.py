"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.llm.bloom import blocks_for, bloom, maybe_listed
from tripledger.staging import Staging
from tripledger.staging import session_staging as stage

__all__ = ["full_text", "row_key", "stage", "table", "without"]
#: Rows of a list beyond which texts are held against a Bloom filter before they are joined.
MANY = 500_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def full_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def row_key(*more: Column) -> Column:
    """What tells rows apart besides their id: the text, null being empty, and ``more``, whose nulls
    differ from all values."""
    parts = [x for c in more for x in (c.isNull(), c)]
    return F.xxhash64(full_text(), *parts)


def without(docs: DataFrame, gone: DataFrame, staging: Staging, *more: Column, many: int = MANY) -> DataFrame:
    """The rows of ``docs`` but those whose ``doc_id`` and ``row_key`` are the ``id`` and ``key`` of a
    row of ``gone``.

    The list is written first, so that Spark knows its size and sends a short one to all tasks
    rather than shuffle the texts. A longer list becomes a Bloom filter of bounded size: rows that
    it does not hold stay where they are, and only the others are joined with the list. Ids may be
    null. Repeated rows go or stay together; an empty list keeps all.
    """
    listed = staging.put(gone.select("id", "key").distinct(), "gone")
    own = listed.toDF("gone_id", "gone_key")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"),
                       row_key(*more).alias("key"))
    same = F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("key") == F.col("gone_key"))
    number = listed.count()
    if number <= many:
        return rows.join(own, same, "left_anti").select("row.*")
    blocks = blocks_for(number)
    asked = maybe_listed(rows, staging.put(bloom(listed.select("key"), blocks), "bloom"), blocks)
    hits = asked.where("maybe").join(own, same, "left_anti")
    return asked.where("NOT maybe").select("row.*").unionByName(hits.select("row.*"))
