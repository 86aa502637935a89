import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from samples import docs, none, rows, staging  # noqa: F401

from tripledger.llm import dedup
from tripledger.llm.common import row_key, without


def trie_of(items, **how):
    trie = dedup.Trie(lambda a, b: a + b, **how)
    for k in items:
        trie.insert(k, 1)
    return trie


@pytest.mark.parametrize("budget", [1 << 40, 3000, 600])
def test_a_trie_counts_strings_in_any_budget(budget, tmp_path):
    rng = random.Random(budget)
    items = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(12))) for _ in range(500)]
    items += [b"x" * 300 + bytes([k % 7]) for k in range(40)] + [b"", b""]
    trie = trie_of(items, budget=budget, folder=str(tmp_path))
    assert bool(trie.spilled) == (budget < 1 << 40)
    assert dict(trie.items()) == Counter(items)
    assert not list(tmp_path.iterdir())


@pytest.mark.parametrize("largest", [True, False])
@pytest.mark.parametrize("budget", [dedup.BUDGET, 2000])
def test_owners_against_brute_force(docs, rows, largest, budget):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[(text or "").encode()].append(doc_id)
    expected = {}
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = (max if largest else min)(known) if known else None
        expected[hashlib.sha256(text).hexdigest()] = (len(text), keep, len(ids), ids.count(keep))
    got = {r.sha: (r.size, r.keep_id, r.rows, r.same) for r in dedup.owners(docs, largest, budget).collect()}
    assert got == expected


def test_every_row_is_told_its_fate(docs, rows, none, staging):
    found = dedup.marked(docs, staging, largest=True).collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows)
    by_text = defaultdict(list)
    for r in found:
        by_text[r.text_sha256].append(r)
    assert len(by_text) == len({r[1] or "" for r in rows})
    for group in by_text.values():
        ids = [r.doc_id for r in group if r.doc_id is not None]
        assert {r.keep_id for r in group} == {max(ids, default=None)}
        assert {r.group_size for r in group} == {len(group)}
        assert [r.doc_id for r in group if r.kept] == [max(ids, default=None)]
    assert dedup.marked(none, staging).count() == 0


def test_dropping_copies_keeps_one_row_and_all_columns(docs, rows, none, staging):
    kept = dedup.drop_copies(docs, staging, largest=True)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert len(got) == len({r[1] or "" for r in rows}) == len({r.text or "" for r in got})
    best = {}
    for doc_id, text, *_ in rows:
        best[text or ""] = max(best.get(text or "", -1), -1 if doc_id is None else doc_id)
    assert all(best[r.text or ""] == (-1 if r.doc_id is None else r.doc_id) for r in got)
    assert dedup.drop_copies(none, staging).count() == 0


def test_null_and_empty_are_one_text(spark, staging):
    """Rows that agree in the id and differ in how their text is empty."""
    df = spark.createDataFrame([(5, None, "a"), (5, "", "b"), (5, "", "b"), (4, "", "c"), (6, "x", "d")],
                               "doc_id long, text string, note string").repartition(3)
    kept = dedup.drop_copies(df, staging, largest=True).collect()
    assert sorted((r.doc_id, r.text or "") for r in kept) == [(5, ""), (6, "x")]
    assert all((r.text, r.note) in {(None, "a"), ("", "b"), ("x", "d")} for r in kept)
    assert sum(r.kept for r in dedup.marked(df, staging, largest=True).collect()) == 2


@pytest.mark.parametrize("many", [0, 10])
def test_listed_rows_go_without_a_shuffle_of_the_texts(spark, docs, rows, staging, many):
    gone = docs.where("doc_id % 3 = 0 OR doc_id IS NULL").select(F.col("doc_id").alias("id"), row_key().alias("key"))
    left = without(docs, gone, staging, many=many)
    assert left.columns == docs.columns
    want = Counter(str(r[0]) for r in rows if r[0] is not None and r[0] % 3)
    assert Counter(str(r.doc_id) for r in left.collect()) == want
    assert without(docs, gone.limit(0), staging, many=many).count() == len(rows)
    plan = without(docs, gone, staging)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
