"""Registered queries: each operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripledger import functions as fn
from tripledger import operators as op
from tripledger.plans import gold, questions, report, silver
from tripledger.plans.raw import file_ledger
from tripledger.sources import insert_absent, publish, write_version
from tripledger.sources.delimited import ORIGIN, read_delimited
from tripledger.staging import session_staging
from tripledger.workload import files, roles
from tripledger.workload.roles import Tables, date_text, dec, money_text, text

Query = Callable[[Tables], DataFrame]
_REGISTRY: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _REGISTRY[function.__name__] = function
    return function


def portable(df: DataFrame) -> DataFrame:
    """Decimals as double, dates and lists as text: types that any two engines share. Only
    for comparing results; the operators themselves keep money exact."""
    def cast(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        return c.alias(f.name)
    return df.select(*[cast(f) for f in df.schema.fields])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query: Query):
        return lambda spark, folder: portable(query(Tables(spark, folder)))
    return {name: bind(query) for name, query in _REGISTRY.items()}


# ---- parsing and text ------------------------------------------------------------------

@_query
def parse_money(t):
    return t.orders.select("o_orderkey", fn.parse_decimal(money_text(F.col("o_totalprice")))
                           .alias("valor"))


@_query
def parse_money_bad(t):
    """Amounts of lines, where some text is bad, out of range or blank."""
    line = F.col("l_linenumber")
    raw = (F.when(line == 1, F.concat(F.lit("R$"), money_text(F.col("l_extendedprice"))))
           .when(line == 2, F.lit("123456789,00")).when(line == 3, F.lit(" "))
           .when(line == 4, F.lit("-0,005"))
           .otherwise(F.concat(F.lit(" "), money_text(F.col("l_extendedprice")))))
    parsed = t.lineitem.select("l_linenumber", raw.alias("x")).select(
        "l_linenumber", "x", fn.parse_decimal("x", strict=False).alias("v"))
    return parsed.groupBy("l_linenumber").agg(
        F.count("v").alias("lidos"), F.sum("v").alias("total"),
        F.count_if(op.parsed("x", "v").column()).alias("invalidos"))


@_query
def parse_date(t):
    d = F.col("o_orderdate")
    mixed = F.when(F.col("o_orderstatus") == "F", date_text(d, "d/M/yyyy")).when(
        F.col("o_orderstatus") == "P", F.concat(F.lit(" "), date_text(d))).otherwise(F.lit(""))
    return t.orders.select("o_orderkey", fn.parse_date(mixed).alias("data"))


@_query
def parse_int(t):
    raw = F.concat(F.lit(" "), text("l_linenumber"), F.lit(" "))
    raw = F.when(F.col("l_returnflag") == "A", F.lit("  ")).otherwise(raw)
    return t.lineitem.select("l_orderkey", fn.parse_int(raw).alias("n"))


@_query
def trip_days(t):
    last = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("_last"))
    joined = t.orders.join(last, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    start = fn.parse_date(date_text(F.col("o_orderdate")))
    end = fn.parse_date(date_text(F.col("_last")))
    return joined.select("o_orderkey", fn.inclusive_days(start, end).alias("dias"))


@_query
def total_value(t):
    def unless(c, flag):
        return F.when(F.col("l_returnflag") != flag, dec(c))
    return t.lineitem.select("l_orderkey", fn.sum_or_zero(
        [unless("l_extendedprice", "A"), unless("l_quantity", "N"), dec("l_tax")],
        [unless("l_discount", "R")]).alias("valor_total"))


@_query
def text_cleanup(t):
    blank = F.when(F.col("p_size") > 25, F.lit("  ")).when(F.col("p_size") > 5, F.col("p_type"))
    return t.part.select(
        "p_partkey", fn.first_part(F.concat("p_name", F.lit(" ,"), "p_type")).alias("primeira"),
        fn.blank_to(blank, "Não Informado").alias("tipo"),
        fn.clean_upper(F.concat(F.lit("  são "), "p_name")).alias("maiuscula"),
        fn.title_case(F.concat(F.lit(" "), F.replace("p_name", F.lit(" "), F.lit("-")),
                               F.lit("'s 3RD"))).alias("titulo"),
        fn.fit_length(F.concat(F.col("p_brand"), F.lit("    ")), 8).alias("curta"))


@_query
def display_text(t):
    price = dec("o_totalprice", 12)
    return t.orders.select(
        "o_orderkey", fn.currency(price).alias("moeda"), fn.thousands("o_orderkey").alias("milhar"),
        fn.scaled(price, "k").alias("mil"))


# ---- first row per key, parents, rules, ids --------------------------------------------

_LINE = ["l_orderkey", "l_linenumber"]


@_query
def keep_first(t):
    return op.keep_first(t.lineitem, _LINE, roles.LINE_ORDER).select(
        *_LINE, "l_partkey", "l_extendedprice")


@_query
def keep_first_null_key(t):
    lines = t.lineitem.withColumn("n", F.nullif("l_linenumber", F.lit(7)))
    return op.keep_first(lines, ["l_orderkey", "n"], roles.LINE_ORDER).select(
        "l_orderkey", "n", "l_partkey", "l_extendedprice")


@_query
def repeated_keys(t):
    return op.unique_key(t.lineitem, _LINE)


@_query
def semi_parent(t):
    return op.with_parent(t.lineitem, t.orders.where("o_orderstatus = 'F'"), "l_orderkey",
                          "o_orderkey", unique=True).select(*_LINE, "l_partkey", "l_quantity")


@_query
def semi_repeated_parent(t):
    """Parts of which some line of over 49 pieces exists: the parents repeat their key."""
    return op.with_parent(t.part, t.lineitem.where("l_quantity > 49"), "p_partkey", "l_partkey"
                          ).select("p_partkey", "p_name")


@_query
def anti_orphans(t):
    lines = t.lineitem.withColumn("k", F.when(F.col("l_linenumber") != 7, F.col("l_orderkey")))
    return op.orphans(lines, t.orders.where("o_orderstatus = 'F'"), "k", "o_orderkey",
                      unique=True).select("k", "l_linenumber", "l_partkey", "l_quantity")


_CUSTOMER_RULES = [
    op.non_negative("c_acctbal"), op.max_length("c_mktsegment", 9), op.not_null("segment")]


def _ruled_customers(t):
    return t.customer.withColumn("segment", F.nullif("c_mktsegment", F.lit("BUILDING")))


@_query
def rule_violations(t):
    lines = t.lineitem.select(
        dec("l_extendedprice").alias("v"),
        F.when(F.col("l_linenumber") == 2, F.lit("x")).otherwise(text("l_quantity")).alias("q"))
    lines = lines.withColumn("n", fn.parse_decimal("q", strict=False))
    return op.rule_summary(_ruled_customers(t), _CUSTOMER_RULES, "customer").unionByName(
        op.rule_summary(lines, [op.in_range("v", 6, 2), op.parsed("q", "n")], "lineitem"))


@_query
def quarantined_rows(t):
    _, bad = op.check(_ruled_customers(t), _CUSTOMER_RULES, "quarantine")
    return bad.select("c_custkey", "regras_quebradas")


@_query
def checked_rows(t):
    good, _ = op.check(_ruled_customers(t), _CUSTOMER_RULES, "quarantine")
    return good.select("c_custkey", "c_acctbal")


@_query
def dense_id(t):
    return op.add_dense_id(t.orders.select("o_orderkey", "o_custkey"), "id", ["o_orderkey"],
                           session_staging(t.spark))


# ---- files -----------------------------------------------------------------------------

def _customer_files(t, staging, **options):
    path = files.write_lines(files.customer_lines(t), ["c_custkey"], files.CUSTOMER_HEADER,
                             staging.path("customer"))
    return read_delimited(t.spark, path, files.CUSTOMER_NAMES, files.CUSTOMER_COLUMNS,
                          with_origin=True, **options)


@_query
def delimited_rows(t):
    return _customer_files(t, session_staging(t.spark)).select(*files.CUSTOMER_COLUMNS)


@_query
def delimited_skipped(t):
    """Records read and skipped, with the reason."""
    staging, skipped = session_staging(t.spark), Observation("skipped")
    read = staging.put(_customer_files(t, staging, skipped=skipped), "rows").agg(
        F.lit("lida").alias("motivo"), F.count(F.lit(1)).alias("registros"))
    return read.unionByName(t.spark.createDataFrame(list(skipped.get.items()), read.schema))


@_query
def file_order_id(t):
    staging = session_staging(t.spark)
    staged = staging.put(_customer_files(t, staging), "rows")
    *chunk, row = ORIGIN
    return op.number_chunks(staged, "id", chunk, row, staging).select("id", "codigo")


@_query
def loaded_payments(t):
    """Payments after the raw and silver loads, with both of their ids."""
    database = files.layers(t.spark, t.folder)
    raw = t.spark.table(f"`{database}`.raw_pagamento").groupBy("tipo_pagamento").agg(
        F.count("id_viagem").alias("raw"), F.max(F.col("id_pagamento").cast("long")).alias("raw_id"))
    clean = t.spark.table(f"`{database}`.silver_pagamento").groupBy("tipo_pagamento").agg(
        F.count(F.lit(1)).alias("silver"), F.max("id_pagamento").alias("silver_id"),
        F.sum(F.col("id_pagamento") * F.col("valor").cast("decimal(28,2)")).alias("prova"))
    return raw.join(clean, "tipo_pagamento")


def _counts(spark: SparkSession, database: str) -> DataFrame:
    counts = [spark.table(f"`{database}`.{name}").agg(F.count(F.lit(1)).alias("linhas")).select(
        F.lit(name).alias("tabela"), "linhas")
        for prefix in ("raw_", "silver_", "quarentena_silver_", "orfaos_silver_")
        for name in [prefix + k for k in ("viagem", "pagamento", "passagem", "trecho")]
        if name != "orfaos_silver_viagem"]
    return reduce(DataFrame.unionByName, counts)


@_query
def loaded_counts(t):
    """Rows of every table that the loads leave."""
    return _counts(t.spark, files.layers(t.spark, t.folder))


@_query
def reloaded_counts(t):
    """The same after a second load, which replaces all tables."""
    return _counts(t.spark, files.reloaded(t.spark, t.folder))


@_query
def loaded_gold(t):
    """The gold table after all loads, read through its view."""
    database = files.layers(t.spark, t.folder)
    gold.build_gold(t.spark, database)
    return t.spark.table(f"`{database}`.view_gold_resumo_executivo")


@_query
def loaded_questions(t):
    """Questions answered from the silver tables that the loads left."""
    database = files.layers(t.spark, t.folder)
    trips, payments, segments = (t.spark.table(f"`{database}`.silver_{k}") for k in ("viagem", "pagamento", "trecho"))

    def part(name: str, answer: DataFrame, key: str, value: str) -> DataFrame:
        return answer.select(F.lit(name).alias("pergunta"), F.col(key).alias("nome"), F.col(value).cast("double").alias("valor"))
    return reduce(DataFrame.unionByName, [
        part("q01", questions.q01(trips), "orgao", "custo_total"),
        part("q03", questions.q03(trips), "id_viagem", "duracao_dias"),
        part("q04", questions.q04(payments), "tipo_pagamento", "volume_total_pago"),
        part("q05", questions.q05(segments), "meio_transporte", "total_trechos"),
        part("q07", questions.q07(trips), "orgao", "valor_consolidado")])


@_query
def loaded_violations(t):
    """Rules that rows broke in the loads, between rows as well, of all four tables."""
    database = files.layers(t.spark, t.folder)
    return t.spark.table(f"`{database}`.{silver.VIOLATIONS}").where("violacoes > 0")


@_query
def loaded_repeats(t):
    """Segments that repeat a key, each with the one that was kept."""
    database = files.layers(t.spark, t.folder)
    return t.spark.table(f"`{database}`.repetidas_silver_trecho").select(
        "id_viagem", "sequencia_trecho", F.col(silver.ORDINAL).alias("ordem"), "ordem_mantida")


@_query
def inserted_rows(t):
    """A table after two batches of line items, of which the second repeats keys of the first."""
    database = files.new_database(t.spark)
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    rows = t.lineitem.select("l_orderkey", "l_returnflag", *order)
    first = rows.where("l_suppkey % 2 = 0").withColumn("lote", F.lit(1))
    publish(t.spark, {"itens": write_version(first.limit(0), "itens", database)}, database)
    for batch in (first, rows.withColumn("lote", F.lit(2))):
        insert_absent(batch, "itens", ["l_orderkey", "l_returnflag"], order, database)
    return t.spark.table(f"`{database}`.itens")


@_query
def appended_payments(t):
    """Raw payments after two appends, the second over all files, of which it reads the new ones."""
    database = files.appended(t.spark, t.folder)
    return t.spark.table(f"`{database}`.raw_pagamento").select(
        F.col(silver.ORDINAL).alias("ordem"), F.col("id_pagamento").cast("long").alias("id_pagamento"),
        "id_viagem", "tipo_pagamento", fn.parse_decimal("valor").alias("valor"))


@_query
def load_report(t):
    """What a load reports, with the rows of its list of files and the trips that are missing."""
    database, loads = files.reported(t.spark, t.folder)

    def count(rows: DataFrame, table: str, value, name: str) -> DataFrame:
        return rows.agg(F.coalesce(value, F.lit(0)).alias(name)).withColumn("tabela", F.lit(table))
    found = ("raw_pagamento", "raw_passagem", "raw_trecho")
    listed = reduce(DataFrame.unionByName, [count(file_ledger(t.spark, k, database), k, F.sum("linhas"), "listadas")
                                            for k in found])
    missing = reduce(DataFrame.unionByName, [count(
        t.spark.table(f"`{database}`.{k}"), k, F.count_if(F.col("id_viagem").isNull()), "sem_viagem") for k in found])
    return loads.select("tabela", "linhas", "descartadas", "situacao").join(listed, "tabela").join(missing, "tabela")


# ---- silver ----------------------------------------------------------------------------

def _good(flagged: DataFrame, table: str) -> DataFrame:
    good, _ = op.split_broken(flagged)
    return good.select(*[f.name for f in silver.SILVER[table].fields if f.name in good.columns])


class _Numbered(Tables):
    """The tables with an ordinal for each line item. Line items are numbered before text is made of
    them, so that sorting and staging handle the typed columns, and text is never stored."""

    @property
    def lineitem(self) -> DataFrame:
        rows = self.spark.read.parquet(f"{self.folder}/lineitem.parquet").select("l_orderkey", *roles.LINE_ORDER)
        return op.add_dense_id(rows, silver.ORDINAL, roles.LINE_ORDER, session_staging(self.spark))


def _numbered(t: Tables, make: Callable[..., DataFrame]) -> DataFrame:
    """Raw text with the ordinal of each row."""
    return make(_Numbered(t.spark, t.folder), silver.ORDINAL)


@_query
def silver_trip(t):
    return _good(silver.flagged(_numbered(t, roles.raw_trips), "silver_viagem"), "silver_viagem")


@_query
def silver_trip_quarantine(t):
    rows = silver.flagged(_numbered(t, roles.raw_trips), "silver_viagem")
    return op.split_broken(rows)[1].select("id_viagem", "num_proposta", "regras_quebradas")


@_query
def silver_payment(t):
    return _good(silver.flagged_child(roles.raw_payments(t), "silver_pagamento",
                                      roles.closed_orders(t), (), None), "silver_pagamento")


@_query
def silver_ticket(t):
    return _good(silver.flagged_child(roles.raw_tickets(t), "silver_passagem",
                                      roles.closed_orders(t), (), None), "silver_passagem")


@_query
def silver_segment(t):
    return _good(silver.flagged_child(_numbered(t, roles.raw_segments), "silver_trecho",
                                      roles.closed_orders(t)), "silver_trecho")


@_query
def silver_payment_violations(t):
    return silver.silver_violations(roles.raw_payments(t), "silver_pagamento",
                                    roles.closed_orders(t))


@_query
def silver_relations(t):
    """Repeated keys and orphans of all four tables."""
    parts = [silver.silver_relations(roles.raw_trips(t), "silver_viagem")]
    for make, table in ((roles.raw_payments, "silver_pagamento"), (roles.raw_tickets, "silver_passagem"),
                        (roles.raw_segments, "silver_trecho")):
        parts.append(silver.silver_relations(make(t), table, roles.closed_orders(t)))
    return reduce(DataFrame.unionByName, parts)


# ---- gold and questions ----------------------------------------------------------------

@_query
def gold_as_written(t):
    return gold.gold_summary(roles.trips(t), roles.payments(t), roles.segments(t))


@_query
def gold_corrected(t):
    return gold.gold_summary(roles.trips(t), roles.payments(t), roles.segments(t), "corrected")


@_query
def q01(t):
    return questions.q01(roles.body_costs(t))


@_query
def q02(t):
    return questions.q02(roles.priced_destinations(t))


@_query
def q02_city(t):
    costs = t.orders.select(text("o_orderkey").alias("id_viagem"),
                            dec("o_totalprice", 12).alias("valor_total"))
    return questions.q02_city(costs, roles.segments(t))


@_query
def q03(t):
    return questions.q03(roles.trips(t))


@_query
def q04(t):
    ranked = questions.q04(roles.payments(t))
    return ranked.withColumn("valor_medio_pagamento", F.round("valor_medio_pagamento", 6))


@_query
def q05(t):
    return questions.q05(roles.segments(t))


@_query
def q05_merged(t):
    return questions.q05(roles.segments(t), merge_labels=True)


@_query
def q05_share(t):
    return questions.q05_share(roles.segments(t))


@_query
def q06(t):
    return questions.q06(roles.segments(t))


@_query
def q07(t):
    return questions.q07(roles.body_costs(t))


@_query
def q07_payer(t):
    return questions.q07_payer(roles.payer_totals(t))


@_query
def answers(t):
    return report.answers(roles.trips(t), roles.payments(t), roles.segments(t))


@_query
def chart_table(t):
    result = None
    for name, chart in report.charts(
            roles.trips(t), roles.payments(t), roles.segments(t)).items():
        part = chart.withColumn("grafico", F.lit(name)).withColumn(
            "valor", F.round(F.col("valor").cast("decimal(28,6)"), 2)).withColumn(
            "limite_eixo", F.round("limite_eixo", 2))
        result = part if result is None else result.unionByName(part, allowMissingColumns=True)
    return result
