"""Ranked summaries: group, aggregate, filter the groups, order and limit."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.functions.parse import _column


def mean(col: Column | str, digits: int | None = 2) -> Column:
    """Average of a decimal or integer column, rounded half up once.

    The values are widened first: Spark gives an average only four digits more than its
    input, and rounding that again could round a value twice.
    """
    average = F.avg(_column(col).cast("decimal(22,10)"))
    return average if digits is None else F.round(average, digits)


def ratio(total: Column, weight: Column, digits: int) -> Column:
    """``total / weight`` for sums that are already aggregated; NULL when the weight is 0."""
    wide = total.cast("decimal(28,2)") / F.nullif(weight.cast("decimal(18,0)"), F.lit(0))
    return F.round(wide, digits)


def ranked(df: DataFrame, keys: Mapping[str, Column | str], aggs: Mapping[str, Column],
           by: str, n: int | None = None, having: Column | None = None) -> DataFrame:
    """Groups ordered by ``by`` from high to low, NULL first, ties by key from low to high.

    ``having`` is a condition on aggregates. With ``n`` Spark keeps the best rows of every
    task and merges those, so the groups are never sorted as a whole.
    """
    grouped = df.groupBy(*[_column(c).alias(name) for name, c in keys.items()])
    columns = [c.alias(name) for name, c in aggs.items()]
    if having is not None:
        result = grouped.agg(*columns, having.alias("_having")).where("_having").drop("_having")
    else:
        result = grouped.agg(*columns)
    ordered = result.orderBy(F.col(by).desc_nulls_first(), *[F.col(k).asc() for k in keys])
    return ordered if n is None else ordered.limit(n)


def share_of_total(df: DataFrame, value: str, name: str, digits: int = 2) -> DataFrame:
    """Add each row's percentage of the sum of ``value``. The sum is a scalar subquery, so
    the rows are not gathered in one task."""
    total = df.agg(F.sum(value)).scalar()
    part = F.col(value).cast("decimal(24,2)") * F.lit(100) / F.nullif(
        total.cast("decimal(24,2)"), F.lit(0))
    return df.withColumn(name, F.round(part, digits))
