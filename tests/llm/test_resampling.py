import hashlib
import math
import random
import re
from zlib import crc32

import brute
import pytest
from pyspark.sql import functions as F
from samples import docs, none, rows, staging  # noqa: F401

from tripledger.llm import resampling

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def features(text, longest):
    words = re.findall(WORDS, (text or "").translate(brute.AZ))
    return [crc32(" ".join(words[i:i + n]).encode()) for n in range(1, longest + 1)
            for i in range(len(words) - n + 1)], len(words)


def expected(texts, target, percent, least, longest, buckets, seed):
    """(id, features, weight, score, drawn) by plain loops over whole texts."""
    counts = [[0] * buckets, [0] * buckets]
    for side, group in enumerate(([t for _, t in texts], target)):
        for t in group:
            for c in features(t, longest)[0]:
                counts[side][c % buckets] += 1
    s, t = counts
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets))))
            for b in range(buckets)]
    out = []
    for i, text in texts:
        found, n = features(text, longest)
        weight = sum(gain[c % buckets] for c in found)
        key = f"{seed}:{i}" if i is not None else str(seed)
        h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(found), weight, score, n >= least))
    able = sorted((x for x in out if x[4]), key=lambda x: (-x[3], x[0] is None, x[0] or 0, -x[2], -x[1]))
    drawn = able[:len(able) * percent // 100]
    ranks = {}
    for k, x in enumerate(drawn):
        ranks.setdefault(x, []).append(k + 1)
    return sorted((*x[:4], ranks[x].pop(0) if ranks.get(x) else None) for x in sorted(
        out, key=lambda x: (x[0] is None, x[0] or 0))) if all(x[0] is not None for x in out) else sorted(
        ((*x[:4], ranks[x].pop(0) if ranks.get(x) else None) for x in out), key=str)


@pytest.mark.parametrize("longest, percent", [(1, 10), (1, 60), (3, 40)])
def test_against_plain_loops(spark, docs, rows, staging, longest, percent):
    target = [rows[0][1], "one two\nthree ONE two\n\nthree four", None, ""]
    items = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    found = resampling.resample(docs, items, staging, percent=percent, least_words=5, longest=longest, buckets=97)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    got = sorted((tuple(r) for r in found.collect()), key=str)
    assert got == sorted(expected([r[:2] for r in rows], target, percent, 5, longest, 97, 2024), key=str)


def test_runs_over_line_ends_are_counted_once(spark):
    """Lines shorter than the features, empty lines and lines of separators."""
    rng = random.Random(4)
    texts = ["".join(rng.choice(["a", "b", "C", " ", "\n", "\n", "é", "-"]) for _ in range(rng.randrange(0, 60)))
             for _ in range(60)] + ["", "\n\n", "a\nb\nc\nd"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    for longest in (1, 2, 4):
        found = resampling.feature_counts(df, longest, 53)
        want = [0] * 53
        for t in texts:
            for c in features(t, longest)[0]:
                want[c % 53] += 1
        assert found.tolist() == want


def test_long_lines_in_pieces(monkeypatch):
    monkeypatch.setattr(resampling, "PIECE", 7)
    text = "Some wOrds of various-lengths, éàü and extraordinarily longwordswithoutend x y z"
    for longest in (1, 2, 3, 5):
        found = [c for _, cs in resampling.line_features(text.encode(), longest) for c in cs]
        assert sorted(found) == sorted(features(text, longest)[0])
        assert sum(n for n, _ in resampling.line_features(text.encode(), longest)) == features(text, 1)[1]
        lines = text.replace(" ", "\n")
        cross = [c for _, cs in resampling.cross_features(lines.encode(), longest) for c in cs]
        inside = [c for line in lines.split("\n") for _, cs in resampling.line_features(line.encode(), longest) for c in cs]
        assert sorted(cross + inside) == sorted(features(text, longest)[0])


def test_lines_are_grouped_before_their_features_are_computed(spark, monkeypatch):
    """A line that all texts share is one row of the task that counts it."""
    df = spark.createDataFrame([("same line here\nown line%d" % k,) for k in range(200)], "text string").repartition(4)
    lines = df.select(F.explode(F.split("text", "\n")).alias("text")).groupBy("text").count()
    assert lines.count() == 201
    found = resampling.feature_counts(df, 1, 1000)
    assert found.sum() == 200 * 5 and found[crc32(b"same") % 1000] >= 200


def test_empty_tables_and_documents(spark, docs, none, rows, staging):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert resampling.resample(none, items, staging).count() == 0
    found = resampling.resample(docs, items.limit(0), staging)
    assert found.count() == len(rows)
    drawn = resampling.drawn_documents(docs, items, staging, percent=50, least_words=5)
    assert drawn.columns == docs.columns
    ranked = resampling.resample(docs, items, staging, percent=50, least_words=5).where("rank is not null")
    key = [F.col("doc_id").cast("string")]
    assert sorted(map(str, drawn.select(*key).collect())) == sorted(map(str, ranked.select(*key).collect()))
