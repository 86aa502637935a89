"""Rules on rows: which rows break them, how many do, and first row per key."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripledger.staging import Staging

BROKEN = "regras_quebradas"
STOPPED = "broken rules: "


class RuleViolation(Exception):
    """Rows break rules and the load asked to stop on that. ``counts`` maps rule to rows; it
    is empty when the load stopped at the first such row."""

    def __init__(self, table: str, counts: dict[str, int] | None = None, detail: str = ""):
        self.table, self.counts = table, counts or {}
        listed = ", ".join(f"{rule}: {n}" for rule, n in sorted(self.counts.items()))
        super().__init__(f"{table}: {listed or detail.strip()}")


def stopped_by(error: Exception) -> str:
    """The rules that made ``guarded`` stop a query; empty for any other error."""
    _, found, rules = str(error).partition(STOPPED)
    return rules.splitlines()[0] if found else ""


@dataclass(frozen=True)
class Rule:
    """A named predicate that is true for a row that breaks the rule; NULL counts as kept."""

    name: str
    broken: Callable[[], Column]

    def column(self) -> Column:
        return F.coalesce(self.broken(), F.lit(False))


def not_null(column: str) -> Rule:
    return Rule(f"nao_nulo:{column}", lambda: F.col(column).isNull())


def non_negative(column: str) -> Rule:
    """NULL passes, as in an SQL CHECK."""
    return Rule(f"nao_negativo:{column}", lambda: F.col(column) < 0)


def max_length(column: str, length: int) -> Rule:
    """Spaces at the end do not count against the length. Characters are only counted where
    there are more bytes than that."""
    return Rule(f"tamanho:{column}", lambda: (F.octet_length(column) > length)
                & (F.length(F.rtrim(F.col(column))) > length))


def parsed(text: str, value: str) -> Rule:
    """The text is not blank, yet gave no value: bad text, or a number out of range."""
    return Rule(f"texto_valido:{value}",
                lambda: F.col(value).isNull() & (F.trim(F.col(text)) != ""))


def in_range(column: str, precision: int, scale: int) -> Rule:
    """The value, rounded to ``scale``, has more digits than ``decimal(precision, scale)``."""
    return Rule(f"faixa:{column}",
                lambda: F.abs(F.round(F.col(column), scale)) >= 10 ** (precision - scale))


def flag_broken(df: DataFrame, rules: Sequence[Rule], name: str = BROKEN) -> DataFrame:
    """Add the array of the names of the rules each row breaks; empty for a good row.

    The flags are computed once per row and then only read. Without the always-true ``rand``
    condition the optimizer would move a filter on them below this projection, written out
    as every rule over every parsed text, and multiply that while it infers constraints.
    """
    hits = F.array_compact(F.array(*[F.when(r.column(), F.lit(r.name)) for r in rules]))
    any_broken = reduce(lambda a, b: a | b, [r.column() for r in rules])
    # The names are put together for bad rows only.
    flags = F.when(any_broken, hits).otherwise(F.array().cast("array<string>"))
    return df.withColumn(name, F.when(F.rand(0) < 2, flags))


def split_broken(flagged: DataFrame, name: str = BROKEN) -> tuple[DataFrame, DataFrame]:
    """Good rows without the flags, and bad rows with them."""
    good = flagged.where(F.size(name) == 0).drop(name)
    return good, flagged.where(F.size(name) > 0)


def guarded(flagged: DataFrame, column: str, name: str = BROKEN) -> DataFrame:
    """Stop the query at the first bad row, in the same pass that writes the good ones.

    The guard sits in ``column``, which the caller must go on to use. It is a projection and
    not a filter, so that it is never moved below a join and run on rows the join drops.
    """
    message = F.concat(F.lit(STOPPED), F.concat_ws(", ", F.col(name)))
    guard = F.when(F.size(name) == 0, F.col(column)).otherwise(F.raise_error(message))
    return flagged.withColumn(column, guard).drop(name)


def rule_summary(df: DataFrame, rules: Sequence[Rule], table: str = "") -> DataFrame:
    """One row per rule with the number of rows that break it, from one aggregate pass."""
    counts = df.agg(*[F.count_if(r.column()).alias(f"_{i}") for i, r in enumerate(rules)])
    rows = F.array(*[
        F.struct(F.lit(r.name).alias("regra"), F.col(f"_{i}").alias("violacoes"))
        for i, r in enumerate(rules)
    ])
    return counts.select(F.lit(table).alias("tabela"), F.inline(rows))


def check(df: DataFrame, rules: Sequence[Rule], mode: str = "fail",
          table: str = "") -> tuple[DataFrame, DataFrame]:
    """Good rows and bad rows. ``fail`` counts first and raises if there are bad ones;
    ``quarantine`` is lazy. Stage a frame that is costly to compute before splitting it."""
    if mode not in ("fail", "quarantine"):
        raise ValueError(f"mode must be 'fail' or 'quarantine', not {mode!r}")
    if mode == "fail":
        found = rule_summary(df, rules, table).where("violacoes > 0").collect()
        if found:
            raise RuleViolation(table, {r.regra: r.violacoes for r in found})
    return split_broken(flag_broken(df, rules))


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               nulls_distinct: bool = True, bypass: Column | None = None,
               row_id: str | None = None) -> DataFrame:
    """The first row in ``order`` for each key.

    Rows with a NULL in their key are all kept when ``nulls_distinct`` (as a UNIQUE constraint
    sees them), and so are rows for which ``bypass`` is true. Name a unique column in
    ``row_id`` to keep these rows in the same pass: it then spreads them over all tasks.
    Without one they take a second pass that needs no shuffle.

    A key that very many rows share is cut to one row per task before the shuffle (Spark
    plans a partial group limit for ``row_number() == 1``).
    """
    free = None
    if nulls_distinct:
        free = _any_null(keys)
    if bypass is not None:
        free = bypass if free is None else free | bypass
    if free is not None:
        free = F.coalesce(free, F.lit(False))

    def first(rows: DataFrame, extra: Sequence[Column] = ()) -> DataFrame:
        window = Window.partitionBy(*keys, *extra).orderBy(*order)
        return (rows.withColumn("_rn", F.row_number().over(window))
                .where(F.col("_rn") == 1).drop("_rn"))

    if free is None:
        return first(df)
    if row_id is not None:
        return first(df, [F.when(free, F.col(row_id))])
    return first(df.where(~free)).unionByName(df.where(free))


def split_repeats(df: DataFrame, keys: Sequence[str], row_id: str, staging: Staging,
                  name: str = "ordem_mantida") -> tuple[DataFrame, DataFrame]:
    """The first row in ``row_id`` for each key, and the rows that repeat one with the ``row_id`` of
    the row that was kept for theirs as ``name``. Rows with a NULL in their key are all kept.

    ``df`` is read several times, so stage it. Keys are counted with a partial sum in every task,
    and only those that repeat are staged, so that Spark knows their size: it sends few to all
    tasks, and joins by shuffle beyond that, where adaptive execution splits a key that very many
    rows share. A window would bring all rows of such a key into one task.
    """
    first = df.where(~_any_null(keys)).groupBy(*keys).agg(F.min(row_id).alias(name), F.count(F.lit(1)).alias("_n"))
    heads = staging.put(first.where("_n > 1").drop("_n"), "repeats")
    keyed = df.where(~_any_null(keys))
    again = F.col(row_id) > F.col(name)
    kept = keyed.join(heads, list(keys), "left").where(F.coalesce(~again, F.lit(True))).select(*df.columns)
    repeated = keyed.join(heads, list(keys)).where(again).select(*df.columns, name)
    return kept.unionByName(df.where(_any_null(keys))), repeated


def absent_rows(batch: DataFrame, stored: DataFrame, keys: Sequence[str], order: Sequence[str], staging: Staging,
                row_id: str | None = None) -> DataFrame:
    """The first row of ``batch`` in ``order`` for each key that ``stored`` does not hold, as an insert
    that does nothing on a conflict leaves them. Rows with a NULL in their key are all kept.

    Of the stored rows only those take part whose first key column lies between the least and the
    greatest of the batch, which reaches the scan, and of these only the keys.
    """
    first = staging.put(keep_first(batch, keys, order, row_id=row_id), "batch")
    low, high = first.agg(F.min(keys[0]), F.max(keys[0])).first()
    if low is None:
        return first
    held = stored.where(F.col(keys[0]).between(F.lit(low), F.lit(high))).select(
        *[F.col(k).alias(f"_tem_{i}") for i, k in enumerate(keys)])
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_tem_{i}") for i, k in enumerate(keys)])
    return first.join(held, same, "left_anti")


def unique_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their number of rows; NULLs are distinct."""
    return (df.where(~_any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("linhas"))
            .where(F.col("linhas") > 1))
