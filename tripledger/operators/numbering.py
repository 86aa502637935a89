"""Consecutive row numbers without a global window.

Rows are held in chunks that follow each other (file splits, or range partitions). A small
table with one row per chunk gives each chunk its offset; the number of a row is that offset
plus its place in the chunk. The rows themselves are never gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripledger.staging import Staging

_CHUNK, _ROW, _FIRST, _COUNT, _OFFSET = "_chunk", "_row", "_first", "_count", "_offset"


def chunk_offsets(staged: DataFrame, chunk: Sequence[str], row: str, staging: Staging, counts: bool = True) -> DataFrame:
    """One row for each chunk of a table for ``number_chunks``, staged: the ``chunk`` columns, the first
    ``row`` of the chunk, its rows (``_count``, with ``counts``) and the rows of all chunks before it."""
    sizes = staged.groupBy(*chunk).agg(F.min(row).alias(_FIRST), F.count(F.lit(1)).alias(_COUNT))
    before = Window.orderBy(*chunk).rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.select("*", F.coalesce(F.sum(_COUNT).over(before), F.lit(0)).alias(_OFFSET))
    return staging.put(placed if counts else placed.drop(_COUNT), "offsets")


def number_chunks(staged: DataFrame, name: str, chunk: Sequence[str], row: str,
                  staging: Staging, start: int = 1, offsets: DataFrame | None = None) -> DataFrame:
    """Number the rows of a staged table whose ``row`` counts up by one inside each chunk.

    ``chunk`` columns order the chunks. The offsets, those of ``chunk_offsets``, are staged too: they
    hold one row per chunk, and with their real size known Spark broadcasts them only while they are
    below ``spark.sql.autoBroadcastJoinThreshold`` and joins by shuffle beyond it.
    """
    if offsets is None:
        offsets = chunk_offsets(staged, chunk, row, staging, counts=False)
    number = F.col(row) - F.col(_FIRST) + F.col(_OFFSET) + F.lit(start)
    kept = [c for c in staged.columns if c not in (*chunk, row)]
    return staged.join(offsets, list(chunk)).select(number.cast("long").alias(name), *kept)


def add_dense_id(df: DataFrame, name: str, order: Sequence[str | Column], staging: Staging,
                 start: int = 1) -> DataFrame:
    """Number the rows ``start``, ``start + 1``, … in the order of ``order``.

    ``order`` must tell any two rows apart, else equal rows are numbered arbitrarily. The
    rows are spread over range partitions and staged once, because range boundaries are
    sampled and would differ if the plan ran twice. The result is read from ``staging``, which
    the caller clears when it is done with it. One row per partition passes through one task.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias(_CHUNK),
                F.monotonically_increasing_id().alias(_ROW))
    )
    return number_chunks(staging.put(placed, "ranges"), name, [_CHUNK], _ROW, staging, start)


#: Power of two of the ordinals that make a chunk of ``renumber``.
_CHUNK_BITS = 16


def renumber(df: DataFrame, name: str, ordinal: str, staging: Staging, start: int = 1,
             of: DataFrame | None = None, less: DataFrame | None = None) -> DataFrame:
    """Number the rows ``start``, ``start + 1``, … in the order of the whole numbers of ``ordinal``, which
    tell rows apart and have gaps, as those of rows that are left of a numbered table.

    Equal stretches of ordinals are the chunks, so nothing is sampled, sorted as a whole or staged but
    a row for each chunk. ``df`` is read twice, the first time the ordinal alone, and must hold the
    same rows both times. NULL comes first. Where ``df`` is the rows ``of`` a table but for those of
    another, ``less``, it is costly to read: then these two are counted and ``df`` is read once.
    """
    chunk = F.coalesce(F.shiftright(F.col(ordinal).cast("long"), _CHUNK_BITS), F.lit(-1 << 62)).alias(_CHUNK)
    rows = df.withColumn(_CHUNK, chunk)
    before = Window.orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    counted = (df if of is None else of).select(chunk, F.lit(1).alias("_n"))
    if less is not None:
        counted = counted.unionByName(less.select(chunk, F.lit(-1).alias("_n")))
    sizes = counted.groupBy(_CHUNK).agg(F.sum("_n").alias(_COUNT))
    offsets = staging.put(sizes.select(
        _CHUNK, F.coalesce(F.sum(_COUNT).over(before), F.lit(0)).alias(_OFFSET)), "offsets")
    place = F.row_number().over(Window.partitionBy(_CHUNK).orderBy(ordinal))
    number = F.col(_ROW) + F.col(_OFFSET) + F.lit(start - 1)
    return rows.withColumn(_ROW, place).join(offsets, _CHUNK).select(number.cast("long").alias(name), *df.columns)
