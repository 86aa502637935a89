import itertools
import random

import brute
import numpy as np
import pytest
from samples import docs, none, rows, staging  # noqa: F401

from tripledger.llm import simhash
from tripledger.llm.graph import components


def test_fingerprints_against_brute_force(rows):
    for _, text, *_ in rows:
        assert simhash.fingerprint(text or "", 4) == brute.simhash(text)


def test_masks_cover_every_pair_within_the_radius():
    for radius in (1, 2):
        covering = simhash.masks(radius, seed=7)
        assert len(covering) == 2 ** (radius + 1) - 1
        for bits in itertools.combinations(range(64), radius):
            differ = sum(1 << b for b in bits)
            assert any((m & (1 << 64) - 1) & differ == 0 for m in covering)
    covering, rng = simhash.masks(4, seed=7), random.Random(1)
    for _ in range(5000):
        differ = sum(1 << b for b in rng.sample(range(64), 4))
        assert any((m & (1 << 64) - 1) & differ == 0 for m in covering)


@pytest.mark.parametrize("most", [2048, 8])
def test_a_forest_connects_what_is_linked(monkeypatch, most):
    monkeypatch.setattr(simhash, "PAIRWISE", most)
    rng = np.random.default_rng(2)
    seeds = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    fps = np.unique([s ^ np.uint64(sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 7))))
                     for s in seeds for _ in range(15)]).astype(np.uint64)
    edges = simhash.forest(fps, 4)
    a, b = (np.concatenate(x) for x in zip(*edges))
    assert (np.bitwise_count(a ^ b) <= 4).all()
    place = {int(f): i for i, f in enumerate(fps)}
    linked = {(place[int(x)], place[int(y)]) for x, y in zip(a, b)}
    linked |= {(y, x) for x, y in linked}
    ids = list(range(len(fps)))
    assert brute.components(ids, lambda i, j: (i, j) in linked) == brute.components(
        ids, lambda i, j: bin(int(fps[i] ^ fps[j])).count("1") <= 4)


def test_components_of_chains_stars_and_loops(spark, staging):
    edges = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(20, 60)] + [(3, 3), (5, 4), (4, 5)]
    found = dict(components(spark.createDataFrame(edges, "a long, b long"), staging).collect())
    assert found == {k: 100 for k in range(101, 141)} | {k: 7 for k in range(20, 60)} | {5: 4}
    assert components(spark.createDataFrame([], "a long, b long"), staging).count() == 0


def test_classes_against_brute_force(docs, rows, none, staging):
    fps = [brute.simhash(r[1]) for r in rows]
    ids = [r[0] for r in rows]
    want = brute.components(ids, lambda i, j: bin(fps[i] ^ fps[j]).count("1") <= 4)
    found = simhash.classes(docs, staging).collect()
    got = sorted(((r.doc_id is None, r.doc_id), r.fp % (1 << 64), r.component_id) for r in found)
    assert got == sorted(((i is None, i), f, c) for i, f, c in zip(ids, fps, want))
    assert simhash.classes(none, staging).count() == 0


def test_one_document_of_each_group_stays(docs, rows, none, staging):
    kept = simhash.drop_near_copies(docs, staging)
    assert kept.columns == docs.columns
    fps = [brute.simhash(r[1]) for r in rows]
    groups = set(brute.components([r[0] for r in rows], lambda i, j: bin(fps[i] ^ fps[j]).count("1") <= 4))
    ids = [r.doc_id for r in kept.collect()]
    assert set(ids) == groups and len(set(ids)) == len(groups)
    assert simhash.drop_near_copies(none, staging).count() == 0
