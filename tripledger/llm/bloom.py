"""A blocked Bloom filter as a table, in DataFrame functions.

A row holds one block of 512 bits. A key sets ``probes`` bits of the one block its hash names, so a
filter is one aggregation over its keys and a lookup is one equi-join with a small table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROBES = 8
#: Keys of a block at which about one other key in 400 passes by mistake, and the most blocks. A
#: block takes 64 bytes, and about twice that where it is joined: a filter is 32 MB at most.
KEYS, LEAST_BLOCKS, MOST_BLOCKS = 32, 1 << 6, 1 << 18


def blocks_for(keys: int) -> int:
    """Blocks for so many keys, a power of two between the two bounds."""
    return min(MOST_BLOCKS, max(LEAST_BLOCKS, 1 << max(0, -(-keys // KEYS) - 1).bit_length()))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _words(key: Column, probes: int) -> Column:
    """Eight 64-bit words with the key's bits set."""
    bits = [F.pmod(F.xxhash64(F.lit(i), key), F.lit(512)).cast("int") for i in range(probes)]
    at = F.array(*bits)
    return F.transform(F.sequence(F.lit(0), F.lit(7)), lambda w: F.aggregate(
        F.filter(at, lambda b: F.shiftright(b, 6) == w), F.lit(0).cast("long"),
        lambda acc, b: acc.bitwiseOR(F.call_function(
            "shiftleft", F.lit(1).cast("long"), b.bitwiseAND(F.lit(63))))))


def bloom(keys: DataFrame, blocks: int, probes: int = PROBES) -> DataFrame:
    """``block`` and its eight ``words`` for every block that holds a bit of column ``key``."""
    rows = keys.select(_block(F.col("key"), blocks).alias("block"), _words(F.col("key"), probes).alias("w"))
    return rows.groupBy("block").agg(F.array(*[F.bit_or(F.col("w")[i]) for i in range(8)]).alias("words"))


def maybe_listed(rows: DataFrame, filters: DataFrame, blocks: int, probes: int = PROBES) -> DataFrame:
    """``rows`` with ``maybe``: whether the filter holds all bits of column ``key``; false for a null
    key. ``filters`` has ``MOST_BLOCKS`` rows at most, so it is sent to all tasks."""
    own = filters.toDF("_bloom_block", "_bloom_words")
    inside = F.forall(F.zip_with(_words(F.col("key"), probes), F.col("_bloom_words"), lambda a, b: a.bitwiseAND(b) == a),
                      lambda ok: ok)
    return rows.join(F.broadcast(own), _block(F.col("key"), blocks) == F.col("_bloom_block"), "left").withColumn(
        "maybe", F.coalesce(inside & F.col("key").isNotNull(), F.lit(False))).drop("_bloom_block", "_bloom_words")
