import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import staging  # noqa: F401

from tripledger.llm import neighbours

SCHEMA = "id long, vector array<float>, label int, dim int, shard int, score double"


def brute(rows, k, wanted):
    """Sorted answers by comparing every query with every other row."""
    def fine(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    rows = sorted({(i, tuple(x + 0.0 for x in v)) for i, v in rows if i is not None and fine(v)})
    out = []
    for i, v in rows:
        if wanted(i):
            far = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(v, w))), j) for j, w in rows
                         if j != i and len(w) == len(v))
            out += [(i, n + 1, j, d) for n, (d, j) in enumerate(far[:k])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 1, 1, 1.0) for i, v in rows], SCHEMA).repartition(4)


def vectors(seed, n, d=8, centres=5):
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(centres, d))
    return (middle[draw.integers(0, centres, n)] + 0.4 * draw.normal(size=(n, d))).astype(np.float32)


def answers(spark, rows, staging, **how):
    df = frame(spark, rows)
    found = neighbours.nearest(df, df.where("id % 10 = 0"), staging, **how)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in found.collect())


def same(got, want):
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) < 1e-12 for g, w in zip(got, want))


def test_small_tables_exactly(spark, staging):
    """Nulls, wrong components, copies, ties, repeated rows and ids, and another dimension."""
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(1, 60))]
    rows += [(100 + i, rows[0][1]) for i in range(30)] + [rows[0], rows[7], (20, [1.0] * 8)]
    rows += [(200, None), (210, []), (220, [0.0] * 8), (230, [None] * 8), (240, [float("nan")] * 8),
             (250, [float("inf")] * 8), (None, rows[3][1]), (300, [1.0, 2.0]), (301, [1.0, -0.0]), (310, [1.0, 0.0])]
    same(answers(spark, rows, staging), brute(rows, 10, lambda i: i % 10 == 0))
    same(answers(spark, rows[:4], staging), brute(rows[:4], 10, lambda i: i % 10 == 0))


def test_shards_and_blocks_give_the_same(spark, staging):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(2, 150))]
    want = brute(rows, 5, lambda i: i % 10 == 0)
    same(answers(spark, rows, staging, k=5, shard_rows=40), want)
    same(answers(spark, rows, staging, k=5, shard_rows=40, block_bytes=512), want)
    same(answers(spark, rows, staging, k=5), want)


def test_recall_and_every_row_is_indexed(spark, staging):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(3, 3000, d=24, centres=12))]
    rows += [(3000 + i, rows[5][1]) for i in range(1500)]  # copies: a third of all rows
    got = answers(spark, rows, staging, k=10, shard_rows=1000, beam=48)
    points = np.array([v for _, v in rows], np.float64)
    ids = np.array([i for i, _ in rows])
    hits = total = 0
    for q in sorted({g[0] for g in got})[::9]:
        far = np.sqrt(((points - points[q]) ** 2).sum(axis=1))
        far[ids == q] = np.inf
        best = far[np.lexsort((ids, far))[9]]
        own = [g for g in got if g[0] == q]
        assert len(own) == 10
        hits += sum(g[3] <= best + 1e-9 for g in own)
        total += 10
    assert hits >= 0.95 * total
    assert {g[0] for g in got} == {i for i, _ in rows if i % 10 == 0}
    copies = [g for g in got if g[0] == 3010]  # ties go to the smallest ids: the first ones' own
    assert [g[2] for g in copies] == [5, *range(3000, 3009)] and all(g[3] == 0 for g in copies)


def test_graph_reaches_every_node():
    draw = np.random.default_rng(5)
    far = np.concatenate([draw.normal(size=(80, 4)), draw.normal(size=(80, 4)) * 1e-3 + 1e3]).astype(np.float32)
    for points in (far, far[:1], far[:2], far[:20]):
        graph, entries = neighbours.build(points, degree=4, beam=8)
        assert not len(neighbours._unreached(graph.astype(np.int64), entries))
        assert (graph != np.arange(len(points))[:, None]).all() and graph.max(initial=0) < len(points)


def test_pruning_keeps_edges_in_different_directions():
    points = np.array([[0, 0], [1, 0], [1.1, 0], [2, 0], [0, 1.5]], np.float32)
    kept = neighbours.prune(points, np.array([0]), np.array([[1, 2, 3, 4, 0, 1]]), 4, 1.2)
    assert kept.tolist() == [[1, 4, -1, -1]]


def test_double_vectors_and_empty_tables(spark, staging):
    rng = random.Random(6)
    rows = [(i, [rng.random() * 1e200 for _ in range(3)]) for i in range(25)]
    df = spark.createDataFrame(rows, "id int, vector array<double>")
    found = neighbours.nearest(df, df.where("id < 3"), staging, k=4)
    assert found.count() == 12 and found.where("score = 0").count() == 0
    empty = df.limit(0)
    assert neighbours.nearest(empty, empty, staging).count() == 0
    assert neighbours.nearest(df, empty, staging).count() == 0
    assert neighbours.nearest(empty, df, staging).count() == 0
    assert neighbours.nearest(df.select("id", F.lit(None).cast("array<double>").alias("vector")), df, staging).count() == 0


@pytest.mark.parametrize("value, fine", [([1.0], True), ([0.0], False), ([], False), (None, False),
                                         ([1.0, None], False), ([float("-inf")], False), ([float("nan"), 1.0], False)])
def test_usable(spark, value, fine):
    df = spark.createDataFrame([(value,)], "v array<double>")
    assert df.select(neighbours.usable(F.col("v"))).first()[0] is fine
