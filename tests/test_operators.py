from collections import defaultdict
from decimal import ROUND_HALF_UP
from decimal import Decimal as D

import pytest
from conftest import plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripledger.operators import (
    RuleViolation,
    absent_rows,
    add_dense_id,
    check,
    in_range,
    keep_first,
    marked_parent,
    max_length,
    mean,
    non_negative,
    not_null,
    orphans,
    parsed,
    ranked,
    ratio,
    rule_summary,
    share_of_total,
    split_repeats,
    summary_over_children,
    unique_key,
    with_parent,
)
from tripledger.functions import parse_decimal
from tripledger.operators.numbering import number_chunks, renumber
from tripledger.staging import Staging

SLOW = settings(max_examples=8, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])


def tuples(df):
    return [tuple(r) for r in df.collect()]


# ---- first row per key -----------------------------------------------------------------

rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.sampled_from([1, 2, None]), st.booleans()),
    max_size=40)


@SLOW
@given(rows_strategy)
def test_keep_first_against_a_loop(spark, rows):
    rows = [(*r, i) for i, r in enumerate(rows)]
    df = spark.createDataFrame(rows, "k string, s int, free boolean, o int").repartition(5)
    seen, strict, loose = set(), [], []
    seen_all = set()
    for r in rows:
        if r[1] is None or r[2]:
            strict.append(r)
        elif r[:2] not in seen:
            seen.add(r[:2])
            strict.append(r)
        if r[:2] not in seen_all:
            seen_all.add(r[:2])
            loose.append(r)
    for row_id in ("o", None):
        kept = keep_first(df, ["k", "s"], ["o"], bypass=F.col("free"), row_id=row_id)
        assert kept.columns == df.columns
        assert sorted(tuples(kept), key=lambda r: r[3]) == strict
    kept = keep_first(df, ["k", "s"], ["o"], nulls_distinct=False)
    assert sorted(tuples(kept), key=lambda r: r[3]) == loose


def test_equal_rows_with_a_null_key_are_all_kept(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", 1), ("a", 1)], "k string, s int")
    assert sorted(tuples(keep_first(df, ["k", "s"], ["k"])), key=str) == [
        ("a", 1), ("a", None), ("a", None)]


def test_repeats_are_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id").repartition(4)
    plan = plan_of(keep_first(df, ["k"], ["id"], row_id="id"))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_unique_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), ("a", None)], "k string, s int")
    assert tuples(unique_key(df, ["k", "s"])) == [("a", 1, 2)]


# ---- parents ---------------------------------------------------------------------------

def test_parents_and_orphans(spark):
    child = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (9, "e")], "k int, v string")
    parent = spark.createDataFrame([(1,), (1,), (2,), (None,), (3,)], "p int")
    for unique in (False, True):
        assert sorted(tuples(with_parent(child, parent, "k", "p", unique))) == [
            (1, "a"), (1, "b"), (2, "c")]
        lost = sorted(tuples(orphans(child, parent, "k", "p", unique)), key=str)
        assert lost == [(9, "e"), (None, "d")]


@pytest.mark.parametrize("unique", [True, False])
def test_a_key_many_children_share_is_split(spark, unique):
    """A third of the children have one parent; its partition is read in several tasks."""
    settings_ = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for k, v in settings_.items():
        spark.conf.set(k, v)
    try:
        child = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("v"))
        parent = spark.range(0, 60000, 2, 8).select(F.col("id").alias("k"))
        parent = parent.union(spark.range(7, 8).select(F.col("id").alias("k")))
        kept = with_parent(child, parent, "k", unique=unique)
        frame = kept.select("k", "v")
        keys = [r.k for r in frame.collect()]
        assert len(keys) == 40001 and keys.count(7) == 20001
        assert "skew=true" in plan_of(frame)
    finally:
        for k in settings_:
            spark.conf.unset(k)


# ---- rules -----------------------------------------------------------------------------

@pytest.fixture
def checked(spark):
    df = spark.createDataFrame(
        [(1, "ok", "1,00"), (2, None, "x"), (3, "too long", "-1,00"), (4, "fit   ", None)],
        "id int, name string, text string")
    df = df.withColumn("value", parse_decimal("text", strict=False))
    rules = [not_null("name"), max_length("name", 3), non_negative("value"), parsed("text", "value")]
    return df, rules


def test_rule_summary(checked):
    df, rules = checked
    assert tuples(rule_summary(df, rules, "t")) == [
        ("t", "nao_nulo:name", 1), ("t", "tamanho:name", 1), ("t", "nao_negativo:value", 1),
        ("t", "texto_valido:value", 1)]


def test_check_quarantine_and_fail(checked):
    df, rules = checked
    good, bad = check(df, rules, "quarantine")
    assert good.columns == df.columns
    assert [r.id for r in good.orderBy("id").collect()] == [1, 4]
    assert [(r.id, r.regras_quebradas) for r in bad.orderBy("id").collect()] == [
        (2, ["nao_nulo:name", "texto_valido:value"]),
        (3, ["tamanho:name", "nao_negativo:value"])]
    with pytest.raises(RuleViolation) as stop:
        check(df, rules, "fail", "t")
    assert stop.value.counts["nao_nulo:name"] == 1 and len(stop.value.counts) == 4
    good, bad = check(good, rules, "fail")
    assert good.count() == 2 and bad.count() == 0
    with pytest.raises(ValueError):
        check(df, rules, "ignore")


def test_in_range(spark):
    df = spark.createDataFrame([(D("99.99"),), (D("100.00"),), (None,)], "x decimal(20,2)")
    assert tuples(rule_summary(df, [in_range("x", 4, 2)]))[0][2] == 1


# ---- numbering -------------------------------------------------------------------------

def test_dense_id(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 37 % 5000).alias("o")).repartition(6)
    out = add_dense_id(df, "n", ["o"], Staging(spark), start=10)
    assert out.columns == ["n", "o"]
    assert sorted(tuples(out)) == [(i + 10, i) for i in range(5000)]


def test_dense_id_needs_no_global_window_over_the_rows(spark):
    with Staging(spark) as staging:
        df = spark.range(0, 5000, 1, 7).select(F.col("id").alias("o"))
        out = add_dense_id(df, "n", [F.col("o").desc()], staging)
        plan = plan_of(out)
        assert "Window" not in plan and "BroadcastHashJoin" in plan
        assert out.agg(F.max(F.col("n") + F.col("o"))).first()[0] == 5000


def test_number_chunks_with_several_chunks_per_task(spark):
    with Staging(spark) as staging:
        rows = [("f1", 0, 0), ("f1", 0, 1), ("f1", 64, 7), ("f1", 64, 8), ("f2", 0, 2), ("f2", 0, 3)]
        df = spark.createDataFrame(rows, "f string, b long, r long")
        df = staging.put(df, "x")
        out = number_chunks(df.withColumn("v", F.concat("f", "b", "r")), "n", ["f", "b"], "r", staging)
        assert [r.v for r in out.orderBy("n").collect()] == [f"{f}{b}{r}" for f, b, r in rows]
        assert [r.n for r in out.orderBy("n").collect()] == [1, 2, 3, 4, 5, 6]


# ---- rankings --------------------------------------------------------------------------

def test_ranked(spark):
    df = spark.createDataFrame(
        [("a", D("1.00")), ("a", D("2.00")), ("b", D("3.00")), ("c", None), (None, D("1.00"))],
        "k string, v decimal(10,2)")
    assert tuples(ranked(df, {"key": "k"}, {"s": F.sum("v")}, by="s")) == [
        ("c", None), ("a", D("3.00")), ("b", D("3.00")), (None, D("1.00"))]
    assert tuples(ranked(df, {"key": "k"}, {"s": F.sum("v")}, by="s", n=1,
                         having=F.count("k") > 1)) == [("a", D("3.00"))]
    assert "TakeOrderedAndProject" in plan_of(ranked(df, {"k": "k"}, {"s": F.sum("v")}, "s", 2))


def test_means_are_rounded_once(spark):
    values = [D("0.01")] * 9 + [D("0.00")] * 11 + [D("0.00")] * 180
    df = spark.createDataFrame([(v,) for v in values], "v decimal(12,2)")
    assert df.select(mean("v", 5), mean("v", 4)).first()[:] == (D("0.00045"), D("0.0005"))
    assert df.select(ratio(F.sum("v"), F.count("v"), 5)).first()[0] == D("0.00045")
    ints = spark.createDataFrame([(1,), (2,), (2,), (4,)], "v int")
    assert ints.select(mean("v", 1)).first()[0] == D("2.3")
    assert df.where("v > 9").select(ratio(F.sum("v"), F.count("v"), 2)).first()[0] is None


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n long")
    out = share_of_total(df, "n", "p")
    assert sorted(tuples(out)) == [("a", 1, D("33.33")), ("b", 2, D("66.67"))]
    assert "Window" not in plan_of(out)
    assert tuples(share_of_total(df.where("n > 5"), "n", "p")) == []


# ---- summary over children -------------------------------------------------------------

trips_strategy = st.lists(
    st.tuples(st.sampled_from(["x", "y", None]), st.integers(-500, 90000),
              st.one_of(st.none(), st.integers(-3, 40)), st.integers(0, 3), st.integers(0, 3)),
    min_size=1, max_size=25)


def half_up(value, step):
    return value.quantize(D(step), ROUND_HALF_UP)


@SLOW
@given(trips_strategy)
def test_summary_is_that_of_the_double_join(spark, trips):
    parent, payments, segments = [], [], []
    for i, (group, cents, days, n_pay, n_seg) in enumerate(trips):
        parent.append((str(i), group, D(cents) / 100, days))
        payments += [(str(i), None if p == 2 else D(cents + p) / 100) for p in range(n_pay)]
        segments += [(str(i), f"{i}-{s}") for s in range(n_seg)]
    payments += [("lost", D("5.00")), (None, D("5.00"))]
    segments += [("lost", "l")]
    t = spark.createDataFrame(parent, "id string, g string, total decimal(12,2), days int")
    p = spark.createDataFrame(payments, "id string, v decimal(10,2)")
    s = spark.createDataFrame(segments, "id string, seg string")
    def summary(form):
        out = summary_over_children(t, "id", {"g": "g"}, total="total", days="days",
                                    payments=p, payment_value="v", segments=s, form=form)
        return sorted(tuples(out), key=str)

    groups = defaultdict(list)
    for i, trip in enumerate(trips):
        groups[trip[0]].append((i, trip))
    for row in summary("as_written"):
        # Every trip once for each pair of its payments and its segments, a missing side counting as one.
        pairs = [(D(cents) / 100, days, None if k in (None, 2) else D(cents + k) / 100)
                 for _, (_, cents, days, n_pay, n_seg) in groups[row[0]]
                 for k in (range(n_pay) if n_pay else [None]) for _ in range(max(1, n_seg))]
        spans = [d for _, d, _ in pairs if d is not None]
        cost, paid = sum(c for c, _, _ in pairs), sum(p for _, _, p in pairs if p is not None)
        assert row[1] == len(groups[row[0]])
        assert row[2] == (half_up(D(sum(spans)) / len(spans), "0.1") if spans else None)
        assert row[3] == cost and row[4] == half_up(cost / len(pairs), "0.01")
        assert row[5] == paid and row[6] == sum(n for _, (_, _, _, _, n) in groups[row[0]])
    for row in summary("corrected"):
        members = groups[row[0]]
        assert row[1] == len(members)
        assert row[3] == sum(D(c) / 100 for _, (_, c, _, _, _) in members)
        assert row[5] == sum(D(c + k) / 100 for _, (_, c, _, n, _) in members
                             for k in range(n) if k != 2)
        assert row[6] == sum(n for _, (_, _, _, _, n) in members)
    with pytest.raises(ValueError):
        summary("other")


def test_summary_joins_no_child_rows(spark):
    t = spark.createDataFrame([("1", "g", D("1.00"), 1)], "id string, g string, total decimal(12,2), days int")
    p = spark.createDataFrame([("1", D("1.00"))], "id string, v decimal(10,2)")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(summary_over_children(t, "id", {"g": "g"}, total="total", days="days",
                                             payments=p, payment_value="v", segments=p))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Expand" not in plan
    # One shuffle for each input and one for the groups.
    assert plan.count("Exchange hashpartitioning") == 4


def test_marked_children_are_those_with_a_parent_and_the_orphans(spark):
    child = spark.createDataFrame([(n, k) for n, k in enumerate(["1", "2", None, "1", None, "9", "\x002"])], "n long, k string")
    parent = spark.createDataFrame([("1",), ("9",), ("9",), (None,), ("\x002",)], "p string")
    got = {r.n: r["_tem_pai"] for r in marked_parent(child, parent, "k", "n", "p").collect()}
    assert got == {0: True, 1: False, 2: False, 3: True, 4: False, 5: True, 6: True}
    assert sorted(n for n, has in got.items() if has) == sorted(r.n for r in with_parent(child, parent, "k", "p").collect())
    plan = plan_of(marked_parent(child, parent, "k", "n", "p"))
    assert plan.count("LeftOuter") == 1 and plan.count("Scan") == 2


def test_rows_whose_key_is_not_stored(spark, tmp_path):
    stored = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (50, "z", 0), (None, "n", 0)], "k int, s string, o int")
    stored.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    batch = spark.createDataFrame([(1, "a", 1), (1, "x", 2), (1, "x", 1), (3, "c", 4), (3, "c", 3), (None, "n", 1), (None, "n", 1)],
                                  "k int, s string, o int")
    with Staging(spark) as staging:
        found = absent_rows(batch, stored, ["k", "s"], ["o"], staging)
        assert sorted(map(str, found.collect())) == sorted(map(str, spark.createDataFrame(
            [(1, "x", 1), (3, "c", 3), (None, "n", 1), (None, "n", 1)], batch.schema).collect()))
        assert "GreaterThanOrEqual(k,1), LessThanOrEqual(k,3)" in plan_of(found)
        assert absent_rows(batch.limit(0), stored, ["k", "s"], ["o"], staging).count() == 0


def test_repeats_are_split_from_first_rows(spark):
    rows = [("a", 1, 5), ("a", 1, 2), ("a", None, 3), ("a", None, 4), (None, 1, 6), ("b", 1, 1), ("a", 1, 9), ("b", 2, 7)]
    df = spark.createDataFrame(rows, "k string, n int, id long")
    with Staging(spark) as staging:
        kept, again = split_repeats(df, ["k", "n"], "id", staging)
        assert kept.columns == df.columns
        assert sorted(r.id for r in kept.collect()) == [1, 2, 3, 4, 6, 7]
        assert sorted((r.id, r.ordem_mantida) for r in again.collect()) == [(5, 2), (9, 2)]
        for part in split_repeats(df.limit(0), ["k", "n"], "id", staging):
            assert part.count() == 0


def test_a_key_that_most_rows_repeat_is_not_one_task(spark):
    """No window and no grouping of the rows themselves: only keys are grouped."""
    df = spark.range(4000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("k"), "id")
    with Staging(spark) as staging:
        kept, again = split_repeats(staging.put(df, "rows"), ["k"], "id", staging)
        assert (kept.count(), again.count()) == (4000 - again.count(), 2666)
        for part in (kept, again):
            plan = plan_of(part)
            assert "Window" not in plan and "Aggregate" not in plan


def test_renumber_closes_gaps_in_the_order_of_the_ordinals(spark):
    ordinals = [None, 1, 2, 5, 65535, 65536, 65537, 200_000, 3_000_000_000, -7]
    df = spark.createDataFrame([(o, str(o)) for o in reversed(ordinals)], "o long, v string").repartition(4)
    with Staging(spark) as staging:
        out = renumber(df, "n", "o", staging, start=10)
        assert out.columns == ["n", "o", "v"]
        got = {r.v: r.n for r in out.collect()}
        assert "rangepartitioning" not in plan_of(out)
        assert renumber(df.limit(0), "n", "o", staging).count() == 0
    ordered = [None, -7, *[o for o in ordinals if o is not None and o > 0]]
    assert got == {str(o): 10 + i for i, o in enumerate(ordered)}


def test_renumber_counts_other_tables_where_its_rows_are_costly(spark):
    of = spark.range(0, 200_000, 3).select(F.col("id").alias("o"))
    less = of.where("o % 7 = 0 OR o BETWEEN 65536 AND 131071")  # a whole chunk is gone
    kept = [o for o in range(0, 200_000, 3) if o % 7 and not 65536 <= o <= 131071]
    read = spark.sparkContext.accumulator(0)
    rows = spark.createDataFrame([(o,) for o in kept], "o long").mapInArrow(
        lambda batches: ((read.add(b.num_rows), b)[1] for b in batches), "o long")
    with Staging(spark) as staging:
        got = renumber(rows, "n", "o", staging, of=of, less=less).collect()
        assert sorted((r.n, r.o) for r in got) == list(enumerate(kept, 1))
    assert read.value == len(kept)
