"""Display text for amounts and counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripledger.functions.parse import _column

# Axis units: divisor and number of digits shown.
UNITS = {"M": 1_000_000, "k": 1_000}


def currency(col: Column | str, prefix: str = "R$ ", digits: int = 2) -> Column:
    return F.concat(F.lit(prefix), F.format_number(F.round(_column(col), digits), digits))


def thousands(col: Column | str) -> Column:
    return F.format_number(_column(col), 0)


def scaled(col: Column | str, unit: str, prefix: str = "R$ ") -> Column:
    """Amount in millions (``M``) or thousands (``k``) without decimals, e.g. ``R$ 12M``."""
    value = _column(col).cast("decimal(38,6)") / F.lit(UNITS[unit])
    return F.concat(F.lit(prefix), F.format_number(value, 0), F.lit(unit))
