import math
from collections import defaultdict
from pathlib import Path

import brute
import duckdb
import pytest
from pyspark.sql import functions as F
from samples import SCHEMA, docs, none, rows, staging  # noqa: F401

from tripledger.llm import mixing
from tripledger.llm.oracle import ORACLE
from tripledger.llm.queries import queries

FOLDER = "/root/testdata/sf0.001"


def filled(sizes, weights, share, cap):
    """Targets by handing the excess on until no source is above its cap."""
    aim, capped = dict.fromkeys(sizes, 0.0), set()
    total = share * sum(sizes.values())
    while True:
        left = total - sum(cap * sizes[s] for s in capped)
        room = sum(weights[s] for s in sizes if s not in capped)
        for s in sizes:
            aim[s] = cap * sizes[s] if s in capped else left * weights[s] / room if room else 0.0
        above = {s for s in sizes if s not in capped and aim[s] > cap * sizes[s]}
        if not above:
            return aim
        capped |= above


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 5, None: 3},
                                   {"a": 0, "b": 10}, {"a": 0, "b": 0}, {"x": 7}, {"a": 3, "b": 900, "c": 2, "d": 400}])
def test_targets_hand_the_excess_on(spark, sizes):
    frame = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    ordered = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weights = {s: [3.0, 1.0, 2.0][k % 3] for k, s in enumerate(ordered)}
    want = filled(sizes, weights, 1.5, 2.0)
    got = {r.source: r.target for r in mixing.targets(frame, [3, 1, 2], 1.5, 2.0).collect()}
    assert set(got) == set(want) and all(math.isclose(got[s], want[s], abs_tol=1e-9) for s in want)


@pytest.mark.parametrize("cells", [1, 4096])
def test_a_mix_comes_near_its_targets_and_repeats(docs, rows, staging, cells):
    taken, aims, whole = defaultdict(int), {}, defaultdict(int)
    found = mixing.mix(docs, staging, cells=cells).collect()
    assert len(found) == len(rows)
    sizes = {(r[0], r[3]): len(brute.words_of(r[1])) for r in rows if r[0] is not None}
    largest = max(sizes.values())
    for r in found:
        assert r.doc_id is None or r.size == sizes[r.doc_id, r.source]
        assert 0 <= r.copies <= 2
        taken[r.source] += r.size * r.copies
        whole[r.source] += r.size
        aims[r.source] = r.target
        assert r.source_size == sum(len(brute.words_of(x[1])) for x in rows if x[3] == r.source)
    for source in aims:
        assert abs(taken[source] - aims[source]) <= largest / 2 + 1
    key = lambda r: (r.doc_id is None, r.doc_id, r.text_key, r.copies)
    again = mixing.mix(docs.repartition(3), staging, cells=4096).collect()
    assert sorted(map(key, again)) == sorted(map(key, found))


def test_mixed_documents_have_all_columns_and_copies(docs, rows, none, staging):
    mixed = mixing.mixed_documents(docs, staging)
    assert [c for c in mixed.columns if c in docs.columns and c not in ("copies", "target")] == [
        c for c in docs.columns if c not in ("copies", "target")]
    assert mixed.where("copies < 1 OR copies > 2").count() == 0
    assert mixed.count() >= sum(1 for r in rows if brute.words_of(r[1])) // 2
    assert mixing.mixed_documents(none, staging).count() == 0


def test_words_are_counted_without_an_array(spark):
    texts = ["", " ", "\t\n", "a", " a  b\x0bc ", ".", ". .", "é\u00a0x y", "x" * 100000 + " " + "y\n" * 1000]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(mixing.word_count(F.col("t")).alias("n"))
    assert [r.n for r in got.collect()] == [len(brute.words_of(t)) for t in texts]


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not present")
@pytest.mark.parametrize("name", list(ORACLE))
def test_queries_agree_with_their_sql(spark, name):
    con = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    got = queries()[name](spark, FOLDER)
    cursor = con.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(got.columns)

    def plain(rows):  # engines add floats up in different orders
        return sorted(str([f"{x:.12g}" if isinstance(x, float) else x for x in r]) for r in rows)
    assert plain(got.select(names).collect()) == plain(cursor.fetchall())
