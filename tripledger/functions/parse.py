"""Text to decimal, date and integer, and the arithmetic on the parsed values.

``strict=True`` stops the query on text that cannot be read, whatever the session's ANSI
setting; ``strict=False`` gives NULL, which the checks in ``operators.quality`` report.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def blank_to_null(col: Column | str) -> Column:
    """Text without outer spaces, NULL when nothing is left. Tabs and line breaks stay."""
    return F.nullif(F.trim(_column(col)), F.lit(""))


def _or_stop(text: Column, value: Column, kind: str) -> Column:
    unreadable = F.concat(F.lit(f"not a valid {kind}: '"), text, F.lit("'"))
    return F.when(text.isNotNull() & value.isNull(), F.raise_error(unreadable)).otherwise(value)


def parse_decimal(col: Column | str, precision: int = 10, scale: int = 2,
                  strict: bool = True) -> Column:
    """Money text like ``1.234,56``: every dot separates thousands, the comma is the decimal
    mark. Extra digits are rounded half up; text or values out of range do not parse."""
    text = blank_to_null(col)
    plain = F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    value = plain.try_cast(DecimalType(precision, scale))
    return _or_stop(text, value, f"decimal({precision},{scale})") if strict else value


def parse_date(col: Column | str, fmt: str = "d/M/yyyy", strict: bool = True) -> Column:
    text = blank_to_null(col)
    value = F.try_to_date(text, fmt)
    return _or_stop(text, value, "date") if strict else value


def parse_int(col: Column | str, strict: bool = True) -> Column:
    text = blank_to_null(col)
    # A failed cast is far slower than the pattern, which matters when much text is bad.
    whole = F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), text)
    value = whole.try_cast("int")
    return _or_stop(text, value, "integer") if strict else value


def sum_or_zero(plus: Sequence[Column | str], minus: Sequence[Column | str] = (),
                precision: int = 12, scale: int = 2) -> Column:
    """Sum of ``plus`` less ``minus`` with NULL taken as 0, so the result is never NULL."""
    zero = F.lit(0).cast(DecimalType(precision, scale))
    total = zero
    for c in plus:
        total = total + F.coalesce(_column(c), zero)
    for c in minus:
        total = total - F.coalesce(_column(c), zero)
    return total.cast(DecimalType(precision, scale))


def inclusive_days(start: Column | str, end: Column | str) -> Column:
    """Days from start to end counting both; zero or negative when end lies before start."""
    return F.datediff(_column(end), _column(start)) + F.lit(1)


def fit_length(col: Column | str, length: int) -> Column:
    """Text cut to ``length`` when only spaces exceed it, as SQL VARCHAR columns store it."""
    text = _column(col)
    too_long = (F.octet_length(text) > length) & (F.length(text) > length)
    return F.when(too_long, F.substring(text, 1, length)).otherwise(text)
