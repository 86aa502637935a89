"""Layered spending analytics on Spark: raw text tables, silver, gold, questions, reports."""

from tripledger.plans.gold import build_gold, gold_summary
from tripledger.plans.raw import append_raw, load_raw
from tripledger.plans.report import answers, chart_table, charts
from tripledger.plans.silver import build_silver, silver_violations

__all__ = ["answers", "append_raw", "build_gold", "build_silver", "chart_table", "charts", "gold_summary",
           "load_raw", "silver_violations"]
