"""Column functions: text to typed values, text clean-up and display text."""

from tripledger.functions.display import currency, scaled, thousands
from tripledger.functions.parse import (
    blank_to_null,
    fit_length,
    inclusive_days,
    parse_date,
    parse_decimal,
    parse_int,
    sum_or_zero,
)
from tripledger.functions.text import blank_to, clean_upper, first_part, title_case

__all__ = [
    "blank_to", "blank_to_null", "clean_upper", "currency", "first_part", "fit_length",
    "inclusive_days", "parse_date", "parse_decimal", "parse_int", "scaled", "sum_or_zero",
    "thousands", "title_case",
]
