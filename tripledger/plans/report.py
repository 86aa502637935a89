"""Answers as text, and tables that a chart can be drawn from."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.functions.display import currency, scaled, thousands
from tripledger.functions.parse import _column
from tripledger.functions.text import blank_to, title_case
from tripledger.plans import questions as q
from tripledger.schemas import BLANK_LABEL


def _sentence(*parts: Column | str) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def answer(result: DataFrame, question: str, text: Column) -> DataFrame:
    """One line from the first row of an ordered result; no line when it is empty."""
    return result.limit(1).select(F.lit(question).alias("pergunta"), text.alias("resposta"))


def answers(trips: DataFrame, payments: DataFrame, segments: DataFrame) -> DataFrame:
    """One computed sentence per question. A question without data gives no row; a name that is
    missing reads as ``Não Informado``, and the payment type is the first that has a mean."""
    def named(name: str) -> Column:
        return blank_to(name, BLANK_LABEL)

    paid = q.q04(payments).where("valor_medio_pagamento IS NOT NULL").orderBy(
        F.desc("valor_medio_pagamento"), "tipo_pagamento")
    lines = [
        answer(q.q01(trips), "q01", _sentence(
            "Maior custo total: ", named("orgao"), ", ", currency("custo_total"), ".")),
        answer(q.q02(trips), "q02", _sentence(
            "Maior custo médio entre destinos com mais de 5 viagens: ",
            F.col("destino_principal"), ", ", currency("custo_medio"), ".")),
        answer(q.q03(trips), "q03", _sentence(
            "Viagem mais longa: ", F.col("duracao_dias").cast("string"), " dias, viajante ",
            F.coalesce(title_case("nome_viajante"), F.lit(BLANK_LABEL)), ", destino ",
            named("destinos"), ", custo ",
            currency("valor_total"), ".")),
        answer(paid, "q04", _sentence(
            "Maior valor médio: ", F.trim("tipo_pagamento"), ", ",
            currency("valor_medio_pagamento"), " em ", thousands("quantidade_pagamentos"),
            " pagamentos, total ", currency("volume_total_pago"), ".")),
        answer(q.q05(segments), "q05", _sentence(
            "Transporte mais usado: ", F.col("meio_transporte"), ", ",
            thousands("total_trechos"), " trechos.")),
        answer(q.q06(segments), "q06", _sentence(
            "UF de destino mais frequente: ", F.col("uf_destino"), ", ",
            thousands("total_ocorrencias"), " trechos.")),
        answer(q.q07(trips), "q07", _sentence(
            "Maior valor consolidado: ", named("orgao"), ", ",
            currency("valor_consolidado"), ".")),
    ]
    return reduce(DataFrame.unionByName, lines)


def chart_table(df: DataFrame, category: str, value: str, factor: float,
                label: Column, axis: Column | None = None) -> DataFrame:
    """Category, value, label and axis limit (largest value times ``factor``) of each bar.

    ``axis`` turns the column ``limite_eixo`` into the text of an axis mark, for which
    ``rotulo_eixo`` is added. The largest value is a scalar subquery over ``df``.
    """
    limit = df.agg(F.max(value)).scalar().cast("decimal(28,6)") * F.lit(str(factor)).cast(
        "decimal(6,2)")
    bars = df.select(F.col(category).alias("categoria"), _column(value).alias("valor"),
                     label.alias("rotulo"), limit.alias("limite_eixo"))
    return bars if axis is None else bars.withColumn("rotulo_eixo", axis)


def _bar_amount(value: str) -> Column:
    return F.when(F.col(value) > 0, currency(value))


def charts(trips: DataFrame, payments: DataFrame, segments: DataFrame) -> dict[str, DataFrame]:
    """The chart table of each question."""
    longest = q.q03(trips)
    days = longest.select(F.lit("Duração da Viagem").alias("c"), F.col("duracao_dias").alias("v"))
    cost = longest.select(F.lit("Custo Total").alias("c"), F.col("valor_total").alias("v"))
    millions, kilos = scaled("limite_eixo", "M"), scaled("limite_eixo", "k")
    return {
        "q01": chart_table(q.q01(trips), "orgao", "custo_total", 1.28,
                           _bar_amount("custo_total"), millions),
        "q02": chart_table(q.q02(trips), "destino_principal", "custo_medio", 1.25,
                           _bar_amount("custo_medio"), kilos),
        "q03_dias": chart_table(days, "c", "v", 1.25,
                                F.concat(F.col("v").cast("string"), F.lit(" dias"))),
        "q03_custo": chart_table(cost, "c", "v", 1.25, currency("v")),
        "q04": chart_table(q.q04(payments), "tipo_pagamento", "valor_medio_pagamento", 1.20,
                           currency("valor_medio_pagamento")),
        "q05": chart_table(q.q05(segments), "meio_transporte", "total_trechos", 1.25,
                           F.concat(thousands("total_trechos"), F.lit(" trechos"))),
        "q06": chart_table(q.q06(segments), "uf_destino", "total_ocorrencias", 1.20,
                           thousands("total_ocorrencias")),
        "q07": chart_table(q.q07(trips), "orgao", "valor_consolidado", 1.28,
                           _bar_amount("valor_consolidado"), millions),
    }
