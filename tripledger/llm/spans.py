"""Places of a regular expression in a text, in DataFrame functions only.

``split`` gives the pieces between the matches and ``regexp_extract_all`` the matches; both scan
alike, so a place is a sum of lengths before it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 256


def _plain_sums(values: Column) -> Column:
    empty = F.array().cast("array<long>")
    start = F.struct(empty.alias("sums"), F.lit(0).cast("long").alias("total"))
    return F.aggregate(values, start, lambda s, v: F.struct(
        F.concat(s["sums"], F.array(s["total"])).alias("sums"), (s["total"] + v).alias("total")),
        lambda s: s["sums"])


def sums_before(values: Column) -> Column:
    """For an array of numbers, the sum of those before each. It goes in blocks of 256, since
    each append copies the array: a text with very many matches is no square of work."""
    values = values.cast("array<long>")
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.greatest(F.size(values), F.lit(1)) - 1) / BLOCK).cast("int")),
        lambda k: F.slice(values, k * BLOCK + 1, BLOCK))
    totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda s, v: s + v))
    return F.flatten(F.zip_with(blocks, _plain_sums(totals),
                                lambda b, s: F.transform(_plain_sums(b), lambda v: v + s)))


def spans(matches: Column, pieces: Column, around: int) -> Column:
    """Structs ``start``, ``end`` (code points, end exclusive), ``match``, ``before``, ``after``:
    the neighbouring text up to ``around`` characters, at most to the next match."""
    lengths = F.zip_with(F.slice(pieces, 1, F.size(matches)), matches,
                         lambda p, m: F.struct(F.length(p).alias("p"), F.length(m).alias("m")))
    starts = sums_before(F.transform(lengths, lambda x: x["p"] + x["m"]))
    placed = F.zip_with(starts, F.transform(lengths, lambda x: x["p"]), lambda s, p: s + p)
    return F.transform(placed, lambda start, i: F.struct(
        start.alias("start"), (start + F.length(F.get(matches, i))).alias("end"),
        F.get(matches, i).alias("match"), F.right(F.get(pieces, i), F.lit(around)).alias("before"),
        F.left(F.get(pieces, i + 1), F.lit(around)).alias("after")))
