"""Summary of parents over two kinds of children, without joining the children's rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.functions.parse import _column
from tripledger.operators.ranking import ratio

FORMS = ("as_written", "corrected")


def summary_over_children(
    parent: DataFrame, key: str, groups: Mapping[str, Column | str], *,
    total: str, days: str,
    payments: DataFrame, payment_value: str,
    segments: DataFrame,
    form: str = "as_written",
) -> DataFrame:
    """Per group: number of parents, mean days, total and mean cost, amount paid, segments.

    ``as_written`` gives what ``parent LEFT JOIN payments LEFT JOIN segments GROUP BY groups``
    gives, where every parent counts once per pair of a payment and a segment; ``corrected``
    counts every parent and payment once. The number of parents and of segments is the same.

    Both children are reduced to one row per key before anything is joined, so the pairs are
    never made and a key with very many children is already small when it is shuffled. The
    parent must hold each key once, and its ``total`` must not be NULL.
    """
    if form not in FORMS:
        raise ValueError(f"form must be one of {FORMS}, not {form!r}")
    per_payment = payments.groupBy(key).agg(
        F.count(F.lit(1)).alias("_np"), F.sum(payment_value).alias("_paid"))
    per_segment = segments.groupBy(key).agg(F.count(F.lit(1)).alias("_nt"))
    rows = (
        parent.select(F.col(key), *[_column(c).alias(name) for name, c in groups.items()],
                      F.col(total).alias("_total"), F.col(days).alias("_days"))
        .join(per_payment, key, "left")
        .join(per_segment, key, "left")
    )
    whole = "decimal(18,0)"
    segments_per_row = F.coalesce("_nt", F.lit(0))
    if form == "as_written":
        paid_weight = F.greatest(segments_per_row, F.lit(1))
        weight = F.greatest(F.coalesce("_np", F.lit(0)), F.lit(1)) * paid_weight
    else:
        paid_weight = weight = F.lit(1)
    weight, paid_weight = weight.cast(whole), paid_weight.cast(whole)
    with_days = F.col("_days").isNotNull()
    sums = rows.groupBy(*groups).agg(
        F.count(F.col(key)).alias("_n"),
        F.sum(segments_per_row).alias("_segments"),
        F.sum(weight).alias("_weight"),
        F.sum(F.when(with_days, weight)).alias("_day_weight"),
        F.sum(F.col("_days") * weight).alias("_day_sum"),
        F.sum(F.col("_total") * weight).alias("_cost"),
        F.sum(F.col("_paid") * paid_weight).alias("_paid_sum"),
    )
    money = "decimal(28,2)"
    return sums.select(
        *groups,
        F.col("_n").alias("total_viagens"),
        ratio(F.col("_day_sum"), F.col("_day_weight"), 1).alias("media_duracao_dias"),
        F.col("_cost").cast(money).alias("custo_total_geral"),
        ratio(F.col("_cost"), F.col("_weight"), 2).alias("custo_medio_viagem"),
        F.coalesce(F.col("_paid_sum"), F.lit(0)).cast(money).alias("total_efetivamente_pago"),
        F.col("_segments").alias("total_trechos_realizados"),
    )
