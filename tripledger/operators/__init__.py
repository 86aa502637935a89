"""DataFrame operators. All take column names, so they serve any table."""

from tripledger.operators.numbering import add_dense_id, number_chunks, renumber
from tripledger.operators.parents import marked_parent, orphans, with_parent
from tripledger.operators.quality import (
    Rule,
    RuleViolation,
    absent_rows,
    check,
    flag_broken,
    guarded,
    in_range,
    keep_first,
    max_length,
    non_negative,
    not_null,
    parsed,
    rule_summary,
    split_broken,
    split_repeats,
    unique_key,
)
from tripledger.operators.ranking import ranked, share_of_total, mean, ratio
from tripledger.operators.rollup import summary_over_children

__all__ = [
    "Rule", "RuleViolation", "absent_rows", "add_dense_id", "check", "flag_broken", "guarded", "in_range",
    "keep_first", "marked_parent", "max_length", "mean", "non_negative", "not_null", "number_chunks", "orphans",
    "parsed", "ranked", "ratio", "renumber", "rule_summary", "share_of_total", "split_broken",
    "split_repeats", "summary_over_children", "unique_key", "with_parent",
]
