"""Raw text to typed, checked and related silver tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripledger.functions.parse import (
    fit_length,
    inclusive_days,
    parse_date,
    parse_decimal,
    parse_int,
    sum_or_zero,
)
from tripledger.operators.numbering import renumber
from tripledger.operators.parents import HAS_PARENT, marked_parent, orphans, with_parent
from tripledger.operators.quality import (
    BROKEN,
    Rule,
    RuleViolation,
    flag_broken,
    guarded,
    keep_first,
    max_length,
    non_negative,
    not_null,
    parsed,
    rule_summary,
    split_broken,
    split_repeats,
    stopped_by,
    unique_key,
)
from tripledger.schemas import (
    COMPUTED,
    GENERATED_IDS,
    KEEP_FIRST_KEYS,
    NON_NEGATIVE,
    NOT_NULL,
    ORDINAL,
    SILVER,
    SILVER_LENGTHS,
)
from tripledger.sources.tables import current_versions, discard, publish, table_name, write_version
from tripledger.staging import DENSE, Staging, lean

KEY = "id_viagem"
CHILDREN = ("silver_pagamento", "silver_passagem", "silver_trecho")
#: Table with the number of rows that break each rule, written by a load that quarantines.
VIOLATIONS = "violacoes_silver"
_TEXT = "_texto_"
# The raw row of a child without a trip.
_ORPHAN = "_orfa"


def raw_of(table: str) -> str:
    return table.replace("silver_", "raw_")


def _data_fields(table: str) -> list[T.StructField]:
    own = GENERATED_IDS.get(raw_of(table))
    return [f for f in SILVER[table].fields if f.name != own and f.name not in COMPUTED]


def typed(raw: DataFrame, table: str, extra: Sequence[str] = ()) -> DataFrame:
    """The table's columns with their types, the text each value came from, and ``extra``."""
    columns = []
    for f in _data_fields(table):
        if isinstance(f.dataType, T.StringType):
            columns.append(F.col(f.name))
            continue
        if isinstance(f.dataType, T.DecimalType):
            value = parse_decimal(f.name, f.dataType.precision, f.dataType.scale, strict=False)
        elif isinstance(f.dataType, T.DateType):
            value = parse_date(f.name, strict=False)
        else:
            value = parse_int(f.name, strict=False)
        columns += [value.alias(f.name), F.col(f.name).alias(_TEXT + f.name)]
    result = raw.select(*columns, *extra)
    if table == "silver_viagem":
        result = result.withColumns({
            "valor_total": sum_or_zero(
                ["valor_diarias", "valor_passagens", "valor_outros_gastos"], ["valor_devolucao"]),
            "duracao_dias": inclusive_days("data_inicio", "data_fim"),
        })
    return result


def rules(table: str) -> list[Rule]:
    """The table's constraints as rules on a ``typed`` frame."""
    values = [f.name for f in _data_fields(table) if not isinstance(f.dataType, T.StringType)]
    return (
        [not_null(c) for c in NOT_NULL[table]]
        + [non_negative(c) for c in NON_NEGATIVE[table]]
        + [max_length(c, n) for c, n in SILVER_LENGTHS[table].items()]
        + [parsed(_TEXT + c, c) for c in values]
    )


def flagged(raw: DataFrame, table: str, order: Sequence[str] = (ORDINAL,),
            row_id: str | None = ORDINAL, repeats: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Typed rows with the rules they break, reduced to the first good row per key unless
    ``repeats`` are to stay, and the columns ``keep``.

    Rows that break a rule pass the reduction, so that each is stopped on or set aside.
    """
    extra = list(dict.fromkeys([*order, *([row_id] if row_id else []), *keep]))
    columns = [f.name for f in SILVER[table].fields if f.name != GENERATED_IDS.get(raw_of(table))]
    extra = [c for c in extra if c not in columns]
    rows = flag_broken(typed(raw, table, extra), rules(table))
    fitted = {c: fit_length(c, n) for c, n in SILVER_LENGTHS[table].items()}
    rows = rows.select(*[fitted[c].alias(c) if c in fitted else c for c in columns],
                       *extra, BROKEN)
    if repeats or table not in KEEP_FIRST_KEYS:
        return rows
    return keep_first(rows, KEEP_FIRST_KEYS[table], order,
                      bypass=F.size(BROKEN) > 0, row_id=row_id)


def flagged_child(raw: DataFrame, table: str, parents: DataFrame,
                  order: Sequence[str] = (ORDINAL,), row_id: str | None = ORDINAL) -> DataFrame:
    """``flagged`` rows whose trip exists.

    First rows are chosen before the trips are joined: all rows of a key have the same trip,
    so the result is the same, and the join is the last shuffle, where adaptive execution can
    split a trip that very many rows share.
    """
    return with_parent(flagged(raw, table, order, row_id), parents, KEY, unique=True)


def _finish(rows: DataFrame, table: str, ids: str, staging: Staging, of: DataFrame | None = None,
            less: DataFrame | None = None) -> DataFrame:
    own = GENERATED_IDS.get(raw_of(table))
    if own and ids == "dense":
        rows = renumber(rows, own, ORDINAL, staging, of=of, less=less)
    elif own:
        rows = rows.withColumn(own, F.col(ORDINAL))
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in SILVER[table].fields])


def _typed_children(raw: DataFrame, table: str, trips: DataFrame, staging: Staging) -> DataFrame:
    """One scan and one join of the children for all that becomes of them: ``flagged`` rows with a mark
    that says whether their trip exists, and the raw row of those for which it does not."""
    marked = marked_parent(raw, trips, KEY, ORDINAL, unique=True)
    orphan = F.when(~F.col(HAS_PARENT), F.struct(*raw.columns))
    rows = flagged(marked.withColumn(_ORPHAN, orphan), table, repeats=True, keep=(HAS_PARENT, _ORPHAN))
    return staging.put(rows, table)


def build_silver(spark: SparkSession, database: str | None = None, mode: str = "fail",
                 ids: str = "ordinal") -> DataFrame:
    """Build the four silver tables from the raw ones and report their rows.

    ``mode="fail"`` stops at a row that breaks a rule and leaves the previous tables;
    ``mode="quarantine"`` moves such rows to ``quarentena_<table>`` with the rules they break.
    Child rows without a trip go to ``orfaos_<table>`` in that mode and are left out in both, and
    rows that repeat a key go to ``repetidas_<table>`` with the ordinal of the row that was kept.
    ``violacoes_silver`` has the rows of each rule, those between rows included, counted from
    these tables and not from the data again. All of these tables change together at the end, and none if anything fails before.

    ``ids="ordinal"`` numbers child rows by their position in the file, which is unique and in
    file order but skips the rows left out. ``ids="dense"`` numbers them 1..N, at the price of
    one more shuffle.
    """
    if mode not in ("fail", "quarantine"):
        raise ValueError(f"mode must be 'fail' or 'quarantine', not {mode!r}")
    if ids not in ("dense", "ordinal"):
        raise ValueError(f"ids must be 'dense' or 'ordinal', not {ids!r}")
    versions: dict[str, str] = {}
    names = [p + t for t in ("silver_viagem", *CHILDREN) for p in ("", "quarentena_", "orfaos_", "repetidas_")]
    base = current_versions(spark, [*names, VIOLATIONS], database)

    def raw(table: str) -> DataFrame:
        return spark.table(table_name(database, raw_of(table)))

    def put(table: str, rows: DataFrame) -> None:
        versions[table] = write_version(rows, table, database)

    def write(table: str, rows: DataFrame, staging: Staging) -> None:
        of = less = None
        if mode == "fail":
            rows = guarded(rows, KEY)
        else:
            rows, bad = split_broken(rows)
            put(f"quarentena_{table}", bad)
            if table in KEEP_FIRST_KEYS:
                of = rows
                rows, again = split_repeats(rows, KEEP_FIRST_KEYS[table], ORDINAL, staging)
                put(f"repetidas_{table}", again)
                less = spark.table(table_name(database, versions[f"repetidas_{table}"]))
        put(table, _finish(rows, table, ids, staging, of, less))

    def stage(table: str, trips: DataFrame) -> tuple[DataFrame, Staging]:
        part = staging.part(f"part_{table}")
        return _typed_children(raw(table), table, trips, part), part

    with lean(spark), Staging(spark, **DENSE) as staging:
        try:
            table = "silver_viagem"
            rows = flagged(raw(table), table, repeats=mode == "quarantine")
            with staging.part(f"part_{table}") as part:
                write(table, rows if mode == "fail" else part.put(rows, table), part)
            trips = spark.table(table_name(database, versions[table])).select(KEY)
            if mode == "fail":
                for table in CHILDREN:
                    write(table, flagged_child(raw(table), table, trips), staging)
            else:
                # One child is shuffled at a time, while what became of the one before is written.
                with ThreadPoolExecutor(1) as pool:
                    ahead = pool.submit(stage, CHILDREN[0], trips)
                    for table, following in zip(CHILDREN, (*CHILDREN[1:], None)):
                        rows, part = ahead.result()
                        if following:
                            ahead = pool.submit(stage, following, trips)
                        put(f"orfaos_{table}", rows.where(~F.col(HAS_PARENT)).select(f"{_ORPHAN}.*"))
                        write(table, rows.where(HAS_PARENT).drop(HAS_PARENT, _ORPHAN), part)
                        part.clear()
                put(VIOLATIONS, _violations(spark, {t: table_name(database, v) for t, v in versions.items()}))
        except Exception as error:
            discard(spark, versions.values(), database)
            if stopped_by(error):
                raise RuleViolation(table, detail=stopped_by(error)) from error
            raise
        publish(spark, versions, database, base)
    return spark.createDataFrame(
        [(t, spark.table(table_name(database, t)).count()) for t in ("silver_viagem", *CHILDREN)],
        "tabela string, linhas long")


def _violations(spark: SparkSession, stored: Mapping[str, str]) -> DataFrame:
    """Rows for each rule of the four tables, zeros included, from the tables of rows set aside."""
    listed, parts = [], []
    for table in ("silver_viagem", *CHILDREN):
        listed += [(table, r.name) for r in rules(table)]
        parts.append(spark.table(stored[f"quarentena_{table}"]).select(
            F.lit(table).alias("tabela"), F.explode(BROKEN).alias("regra")))
        for rule, aside in ((f"unico:{'+'.join(KEEP_FIRST_KEYS.get(table, []))}", f"repetidas_{table}"),
                            (f"existe:{KEY}", f"orfaos_{table}")):
            if aside in stored:
                listed.append((table, rule))
                parts.append(spark.table(stored[aside]).select(F.lit(table).alias("tabela"), F.lit(rule).alias("regra")))
    counts = reduce(DataFrame.unionByName, parts).groupBy("tabela", "regra").agg(F.count(F.lit(1)).alias("violacoes"))
    return spark.createDataFrame(listed, "tabela string, regra string").join(counts, ["tabela", "regra"], "left").select(
        "tabela", "regra", F.coalesce("violacoes", F.lit(0)).cast("long").alias("violacoes"))


def silver_violations(raw: DataFrame, table: str, parents: DataFrame | None = None) -> DataFrame:
    """Rows per rule that a load of ``raw`` would stop on; orphans are not counted."""
    rows = typed(raw, table)
    if parents is not None:
        rows = with_parent(rows, parents, KEY, unique=True)
    return rule_summary(rows, rules(table), table)



def silver_relations(raw: DataFrame, table: str, parents: DataFrame | None = None) -> DataFrame:
    """The rules between rows, in the form of ``silver_violations``: rows that repeat a key that
    should be unique (``unico``), and child rows without a trip (``existe``). A load leaves both
    out rather than stop on them."""
    found = []
    keys = KEEP_FIRST_KEYS.get(table)
    if keys:
        more = F.coalesce(F.sum(F.col("linhas") - 1), F.lit(0)).cast("long").alias("violacoes")
        found.append(unique_key(typed(raw, table), keys).agg(more).select(
            F.lit("unico:" + "+".join(keys)).alias("regra"), "violacoes"))
    if parents is not None:
        found.append(orphans(raw, parents, KEY, unique=True).agg(F.count(F.lit(1)).alias("violacoes")).select(
            F.lit(f"existe:{KEY}").alias("regra"), "violacoes"))
    return reduce(DataFrame.unionByName, found).select(F.lit(table).alias("tabela"), "regra", "violacoes")
