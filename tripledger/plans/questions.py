"""The business questions, each from silver frames to a small result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger.functions.text import blank_to, clean_upper, first_part
from tripledger.operators.ranking import mean, ranked, ratio, share_of_total
from tripledger.schemas import BLANK_LABEL


def _not_blank(column: str):
    return F.col(column).isNotNull() & (F.trim(column) != "")


def _total(column: str):
    return F.round(F.sum(column), 2)


def q01(trips: DataFrame) -> DataFrame:
    """The five bodies with the highest total cost."""
    return ranked(trips, {"orgao": "nome_orgao_superior"},
                  {"custo_total": _total("valor_total")}, by="custo_total", n=5)


def q02(trips: DataFrame) -> DataFrame:
    """The three first destinations with the highest mean cost, of those with over 5 trips."""
    named = trips.where(F.col("destinos").isNotNull() & (F.col("destinos") != ""))
    return ranked(named, {"destino_principal": first_part("destinos")},
                  {"custo_medio": mean("valor_total")}, by="custo_medio", n=3,
                  having=F.count("id_viagem") > 5)


def q02_city(trips: DataFrame, segments: DataFrame, n: int = 3) -> DataFrame:
    """The cities with the highest mean trip cost, over the segments that lead there.

    Segments are counted per trip and city before the join, so a trip with very many of them
    brings one row per city.
    """
    visits = segments.groupBy("id_viagem", "destino_cidade").agg(
        F.count(F.lit(1)).alias("_visits"))
    joined = visits.join(trips.select("id_viagem", "valor_total"), "id_viagem")
    weight = F.col("_visits").cast("decimal(18,0)")
    return ranked(
        joined, {"destino_cidade": "destino_cidade"},
        {"custo_medio": ratio(F.sum(F.col("valor_total") * weight), F.sum(weight), 2)},
        by="custo_medio", n=n)


def q03(trips: DataFrame) -> DataFrame:
    """The longest trip among those with a positive cost."""
    valid = trips.where((F.col("valor_total") > 0) & F.col("duracao_dias").isNotNull())
    return (valid.select("id_viagem", "nome_viajante", "destinos", "duracao_dias", "valor_total")
            .orderBy(F.col("duracao_dias").desc(), "id_viagem").limit(1))


def q04(payments: DataFrame) -> DataFrame:
    """Payment types by mean value."""
    return ranked(
        payments.where(_not_blank("tipo_pagamento")), {"tipo_pagamento": "tipo_pagamento"},
        {"quantidade_pagamentos": F.count(F.lit(1)), "volume_total_pago": F.sum("valor"),
         "valor_medio_pagamento": mean("valor", None)},
        by="valor_medio_pagamento")


def q05(segments: DataFrame, merge_labels: bool = False) -> DataFrame:
    """Segments per means of transport.

    The groups are the values as they are, and only their label is cleaned, so NULL, empty
    and blank come out as separate rows of the same label; ``merge_labels`` joins them.
    """
    label = blank_to("meio_transporte", BLANK_LABEL)
    count = {"total_trechos": F.count(F.lit(1))}
    if merge_labels:
        return ranked(segments, {"meio_transporte": label}, count, by="total_trechos")
    return ranked(segments, {"meio_transporte": "meio_transporte"}, count,
                  by="total_trechos").withColumn("meio_transporte", label)


def q05_share(segments: DataFrame, merge_labels: bool = True) -> DataFrame:
    """Segments per means of transport with their percentage of all segments."""
    shares = share_of_total(q05(segments, merge_labels), "total_trechos", "percentual")
    return shares.orderBy(F.col("total_trechos").desc(), "meio_transporte")


def q06(segments: DataFrame) -> DataFrame:
    """The ten states that most segments lead to."""
    return ranked(segments.where(_not_blank("destino_uf")),
                  {"uf_destino": clean_upper("destino_uf")},
                  {"total_ocorrencias": F.count(F.lit(1))}, by="total_ocorrencias", n=10)


def q07(trips: DataFrame) -> DataFrame:
    """The three bodies with the highest consolidated cost."""
    return ranked(trips, {"orgao": "nome_orgao_superior"},
                  {"valor_consolidado": _total("valor_total")}, by="valor_consolidado", n=3)


def q07_payer(payments: DataFrame, n: int | None = None) -> DataFrame:
    """Amount paid by each paying body."""
    return ranked(payments, {"orgao_pagador": "nome_orgao_pagador"},
                  {"total_pago": _total("valor")}, by="total_pago", n=n)
