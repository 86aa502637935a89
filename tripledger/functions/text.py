"""Clean-up of category and name text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripledger.functions.parse import _column, blank_to_null


def first_part(col: Column | str, sep: str = ",") -> Column:
    """Trimmed text before the first ``sep``; the whole text when there is none."""
    return F.trim(F.split_part(_column(col), F.lit(sep), F.lit(1)))


def blank_to(col: Column | str, label: str) -> Column:
    """Trimmed text, or ``label`` for NULL and blank."""
    return F.coalesce(blank_to_null(col), F.lit(label))


def clean_upper(col: Column | str) -> Column:
    return F.upper(F.trim(_column(col)))


def title_case(col: Column | str) -> Column:
    """Trimmed text with a capital after every character that is not a letter.

    ``initcap`` starts a word at spaces only. A mark and a space are put before each letter
    that follows a hyphen, apostrophe, digit and so on, and taken out again afterwards.
    """
    mark = "\u0001 "
    split = F.regexp_replace(F.lower(_column(col)), r"([^\p{L} ])(?=\p{L})", "$1" + mark)
    return F.trim(F.replace(F.initcap(split), F.lit(mark), F.lit("")))
