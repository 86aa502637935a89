"""The test tables in the roles of trips, payments, tickets and segments.

An order is a trip, its customer's nation the body, a line item a payment or a segment. Raw
text is made from the typed columns, with holes and rule breakers at fixed line numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.schemas import raw_columns


class Tables:
    """The test tables of one scale factor."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def dec(column: str, precision: int = 10) -> Column:
    return F.col(column).cast(f"decimal({precision},2)")


def money_text(col: Column) -> Column:
    """1234.5 as ``1.234,50``."""
    return F.translate(F.format_number(col, 2), ",.", ".,")


def date_text(col: Column, pattern: str = "dd/MM/yyyy") -> Column:
    return F.date_format(col, pattern)


def text(column: str) -> Column:
    return F.col(column).cast("string")


# ---- silver-like frames for gold, questions and reports --------------------------------

def bodies(t: Tables) -> DataFrame:
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "n_name",
        text("n_nationkey").alias("cod_orgao_superior"),
        F.col("n_name").alias("nome_orgao_superior"))


def trips(t: Tables) -> DataFrame:
    """One row per order; its days run from the order to its last shipment. Open orders
    (status O) cost nothing, and orders without lines have no days.

    The join on the trip comes last: the joins of payments and segments then find the rows
    where they are.
    """
    last = t.lineitem.groupBy(text("l_orderkey").alias("id_viagem")).agg(
        F.max("l_shipdate").alias("_last"))
    cost = F.when(F.col("o_orderstatus") == "O", F.lit(0)).otherwise(F.col("o_totalprice"))
    orders = t.orders.join(bodies(t), "o_custkey").select(
        text("o_orderkey").alias("id_viagem"), "cod_orgao_superior", "nome_orgao_superior",
        F.lower(F.replace("c_name", F.lit("#"), F.lit("-no"))).alias("nome_viajante"),
        F.concat(F.lit(" "), F.col("n_name"), F.lit(", "), F.col("o_orderpriority")).alias(
            "destinos"),
        cost.cast("decimal(12,2)").alias("valor_total"), "o_orderdate")
    return orders.join(last, "id_viagem", "left").select(
        *[c for c in orders.columns if c != "o_orderdate"],
        (F.datediff("_last", "o_orderdate") + 1).alias("duracao_dias"))


def body_costs(t: Tables) -> DataFrame:
    """Cost per customer with the body: orders are added up per customer before they meet the
    customers, so one with very many orders is a single row in the join."""
    per_customer = t.orders.groupBy("o_custkey").agg(
        F.sum(dec("o_totalprice", 12)).alias("valor_total"))
    return per_customer.join(bodies(t).select("o_custkey", "nome_orgao_superior"), "o_custkey")


def priced_destinations(t: Tables) -> DataFrame:
    return t.part.select(
        text("p_partkey").alias("id_viagem"), dec("p_retailprice", 12).alias("valor_total"),
        F.when(F.col("p_size") != 1, F.concat("p_name", F.lit(" , "), "p_type"))
        .otherwise(F.when(F.col("p_brand") > "Brand#2", F.lit(""))).alias("destinos"))


def payments(t: Tables) -> DataFrame:
    line = F.col("l_linenumber")
    kind = F.concat(F.col("l_returnflag"), F.lit("/"), F.col("l_linestatus"))
    return t.lineitem.select(
        text("l_orderkey").alias("id_viagem"),
        F.when(line == 7, F.lit(" ")).when(line != 6, kind).alias("tipo_pagamento"),
        F.when(line != 3, dec("l_extendedprice")).alias("valor"))


def payer_totals(t: Tables) -> DataFrame:
    """Paid per supplier, with its name; line items are added up before the join."""
    per_supplier = t.lineitem.groupBy("l_suppkey").agg(
        F.sum(dec("l_extendedprice")).alias("valor"))
    return per_supplier.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("s_name").alias("nome_orgao_pagador"), "valor")


def segments(t: Tables) -> DataFrame:
    line = F.col("l_linenumber")
    mode = (F.when(line == 2, F.lit("")).when(line == 3, F.lit("  "))
            .when(line == 4, F.lit(" A ")).when(line != 1, F.col("l_returnflag")))
    return t.lineitem.select(
        text("l_orderkey").alias("id_viagem"), mode.alias("meio_transporte"),
        F.concat(F.lit("Cidade "), text("l_suppkey")).alias("destino_cidade"),
        F.when(line == 5, F.lit(" ")).when(
            line != 6, F.concat(F.lit(" nação "), text("l_quantity"))).alias("destino_uf"))


# ---- raw text frames -------------------------------------------------------------------

def _raw(df: DataFrame, table: str, columns: dict[str, Column], *extra: str) -> DataFrame:
    null = F.lit(None).cast("string")
    return df.select(*[columns.get(c, null).alias(c) for c in raw_columns(table)], *extra)


# Order of repeated trips and segments: by all columns, as the table has no row id.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def raw_trips(t: Tables, *extra: str) -> DataFrame:
    """A trip record per line item, so that an order's records repeat its id."""
    line = F.col("l_linenumber")
    daily = money_text(F.col("l_extendedprice"))
    return _raw(t.lineitem, "raw_viagem", {
        "id_viagem": text("l_orderkey"),
        "num_proposta": text("l_partkey"),
        "situacao": F.lit("Realizada"),
        "viagem_urgente": F.when(F.col("l_quantity") == 50, F.lit("TALVEZ")).otherwise(
            F.lit("SIM  ")),
        "nome_orgao_superior": F.when(line != 7, F.col("l_returnflag")),
        "data_inicio": date_text(F.col("l_shipdate")),
        "data_fim": F.when(F.col("l_tax") > 0, F.concat(
            F.lit(" "), date_text(F.date_add("l_shipdate", line), "d/M/yyyy"))),
        "valor_diarias": F.when(line == 6, F.concat(F.lit("-"), daily)).otherwise(daily),
        "valor_passagens": F.when(F.col("l_returnflag") == "A", F.lit("  ")).otherwise(
            money_text(F.col("l_quantity"))),
        "valor_devolucao": money_text(F.col("l_discount")),
        "valor_outros_gastos": F.when(F.col("l_tax") == 0.08, F.lit("1,5x")),
    }, *extra)


def closed_orders(t: Tables) -> DataFrame:
    """The parents: orders with status F. The other line items are orphans."""
    return t.orders.where(F.col("o_orderstatus") == "F").select(
        text("o_orderkey").alias("id_viagem"))


def raw_payments(t: Tables) -> DataFrame:
    line = F.col("l_linenumber")
    return _raw(t.lineitem, "raw_pagamento", {
        "id_viagem": text("l_orderkey"),
        "num_proposta": text("l_partkey"),
        "nome_orgao_pagador": text("l_suppkey"),
        "tipo_pagamento": F.when(line != 7, F.col("l_returnflag")),
        "valor": F.when(line == 6, F.lit("-0,01")).when(line == 5, F.lit(" ")).otherwise(
            money_text(F.col("l_extendedprice"))),
    })


def raw_tickets(t: Tables) -> DataFrame:
    """Line items with their part. Only the part's name is looked up."""
    joined = t.lineitem.join(t.part.select("p_partkey", "p_name"),
                             F.col("l_partkey") == F.col("p_partkey"))
    line = F.col("l_linenumber")
    return _raw(joined, "raw_passagem", {
        "id_viagem": text("l_orderkey"),
        "meio_transporte": F.col("l_returnflag"),
        "cidade_destino_ida": F.col("p_name"),
        "valor_passagem": F.when(line == 4, F.lit("123456789,00")).otherwise(
            money_text(F.col("l_extendedprice"))),
        "taxa_servico": money_text(F.col("l_tax")),
        "data_emissao": F.when(line == 3, F.lit("31/02/2025")).otherwise(
            date_text(F.col("l_shipdate"))),
    })


def raw_segments(t: Tables, *extra: str) -> DataFrame:
    line = F.col("l_linenumber")
    return _raw(t.lineitem, "raw_trecho", {
        "id_viagem": text("l_orderkey"),
        "sequencia_trecho": F.when(line == 6, F.lit("1.5")).when(line != 7, F.concat(
            F.lit(" "), line.cast("string"))),
        "origem_data": date_text(F.col("l_shipdate")),
        "destino_cidade": text("l_suppkey"),
        "meio_transporte": F.col("l_returnflag"),
        "numero_diarias": money_text(F.col("l_quantity")),
    }, *extra)
