"""Importance resampling towards a target distribution, with hashed n-gram features.

A feature is a run of 1 to ``longest`` consecutive words, its bucket the CRC-32 of its bytes modulo
``buckets``. The gain of a bucket says how much more frequent it is in the target than in the
corpus, a document's weight is the sum of gains over its features, and the documents with the
highest weight plus Gumbel noise from their id are drawn, which samples without replacement by
weight.

Counts come from segments: a line break never lies inside a word, so texts are cut into lines,
equal lines are counted by a grouped aggregation, the features of each distinct line are computed
once and multiplied by its occurrences, and only the n-grams that reach over a line's end are
added from the texts themselves. Every text counts whole. The result of the counts is one number
for each bucket, whatever the corpus.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripledger.llm.common import full_text
from tripledger.operators.numbering import add_dense_id
from tripledger.staging import Staging

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
BREAK = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
PIECE = 1 << 20
CACHE = 16 << 20


def _pieces(line: bytes, longest: int) -> Iterator[list[bytes]]:
    """The words of a line, a megabyte at a time. A piece begins with the last ``longest - 1``
    words of the one before it."""
    at, kept = 0, []
    while at < len(line):
        cut = BREAK.search(line, at + PIECE)
        end = cut.start() if cut else len(line)
        found = kept + WORDS.findall(line[at:end].translate(LOWER))
        yield found
        kept, at = found[max(0, len(found) - longest + 1):], end


def line_features(line: bytes, longest: int) -> Iterator[tuple[int, list[int]]]:
    """Words of a line, and CRC-32 of every feature inside it, piece by piece."""
    old = 0
    for words in _pieces(line, longest):
        found = [crc32(w) for w in words[old:]]
        for n in range(2, longest + 1):  # runs among the words the piece begins with are old
            found += [crc32(b" ".join(words[i:i + n])) for i in range(max(0, old - n + 1), len(words) - n + 1)]
        yield len(words) - old, found
        old = min(len(words), longest - 1)


def cross_features(text: bytes, longest: int) -> Iterator[tuple[int, list[int]]]:
    """No words, and CRC-32 of every feature of a text that begins in one line and ends in another,
    line by line."""
    before: list[bytes] = []  # the last words so far
    for line in text.split(b"\n") if longest > 1 else ():
        joined = before + list(islice((w for piece in _pieces(line, 1) for w in piece), longest - 1))
        yield 0, [crc32(b" ".join(joined[i:i + n])) for i in range(len(before))
                  for n in range(len(before) - i + 1, min(longest, len(joined) - i) + 1)]
        before = (before + _last(line, longest - 1))[1 - longest:]


def _last(line: bytes, n: int) -> list[bytes]:
    """The last ``n`` words, from a suffix that grows until it holds one more, as its first may be
    cut."""
    size = 256
    while True:
        words = WORDS.findall(line[-size:].translate(LOWER))
        if size >= len(line) or len(words) > n:
            return words[-n:]
        size *= 8


def _bucket_counts(longest: int, buckets: int, across: bool):
    """Sums by bucket of a task's rows: ``text`` and how often it occurs, ``n``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(buckets, np.int64)
        for batch in batches:
            held: list[int] = []
            times: list[tuple[int, int]] = []
            for value, n in zip(batch.column("text"), batch.column("n").to_pylist()):
                text = value.as_buffer().to_pybytes()
                for _, new in (cross_features if across else line_features)(text, longest):
                    held += new
                    times.append((n, len(new)))
                    if len(held) > PIECE:
                        _add(totals, held, times)
                        held, times = [], []
            _add(totals, held, times)
        at = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(totals[at])], names=["bucket", "n"])
    return work


def _add(totals: np.ndarray, held: list[int], times: list[tuple[int, int]]) -> None:
    if held:
        n, sizes = np.array(times, np.int64).T
        np.add.at(totals, np.array(held, np.int64) % len(totals), np.repeat(n, sizes))


def feature_counts(texts: DataFrame, longest: int = 1, buckets: int = 10_000) -> np.ndarray:
    """Features of all ``text`` by bucket. Null text has none; an empty table gives zeros."""
    whole = texts.where("text IS NOT NULL").select("text")
    lines = whole.select(F.explode(F.split("text", "\n")).alias("text")).where("text <> ''").groupBy("text").agg(
        F.count(F.lit(1)).alias("n"))
    counted = lines.mapInArrow(_bucket_counts(longest, buckets, False), "bucket int, n long")
    if longest > 1:
        counted = counted.unionByName(whole.select("text", F.lit(1).cast("long").alias("n")).mapInArrow(
            _bucket_counts(longest, buckets, True), "bucket int, n long"))
    found = np.zeros(buckets, np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():  # a row for each bucket at most
        found[bucket] = n
    return found


@dataclass(frozen=True)
class Gains:
    """Whole-number gain of each bucket, in thousandths."""
    values: np.ndarray
    longest: int

    @classmethod
    def between(cls, corpus: np.ndarray, target: np.ndarray, longest: int) -> "Gains":
        """floor(1000 ln(((t+1)/(T+buckets)) / ((s+1)/(S+buckets)))) from the two counts."""
        room, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
        return cls(np.array([
            math.floor(1000 * math.log((t + 1.0) * (s_all + float(room)) / ((s + 1.0) * (t_all + float(room)))))
            for s, t in zip(corpus.tolist(), target.tolist())], np.int64), longest)


def weighed(rows: DataFrame, gains: Gains) -> DataFrame:
    """``rows`` without ``text``, with ``n_words``, ``n_features`` and ``weight``. In a batch the
    features of a line are looked up once, however often it occurs there."""
    values, longest = gains.values, gains.longest
    keep = [c for c in rows.columns if c != "text"]

    def sums(pieces: Iterator[tuple[int, list[int]]]) -> tuple[int, int, int]:
        words = features = weight = 0
        for n, crcs in pieces:
            words, features = words + n, features + len(crcs)
            weight += int(values[np.array(crcs, np.int64) % len(values)].sum())
        return words, features, weight

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[int]] = []
            cache: dict[bytes, tuple[int, int, int]] = {}
            held = 0
            for value in batch.column("text"):
                text = value.as_buffer().to_pybytes()
                parts = [sums(cross_features(text, longest))]
                for line in text.split(b"\n"):
                    if line not in cache:
                        if held > CACHE:
                            cache, held = {}, 0
                        cache[line] = sums(line_features(line, longest))
                        held += len(line) + 200
                    parts.append(cache[line])
                out.append([sum(x) for x in zip(*parts)])
            totals = np.array(out, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), *(pa.array(totals[:, k]) for k in range(3))],
                names=[*keep, "n_words", "n_features", "weight"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema.fields)
    return rows.select(*keep, "text").mapInArrow(
        work, f"{kinds}, n_words long, n_features long, weight long")


def gumbel(key, seed: int):
    """floor(-1000 ln(-ln u)), with u from the first 32 bits of the SHA-256 of seed and key."""
    bits = F.conv(F.substring(F.sha2(F.encode(F.concat_ws(":", F.lit(str(seed)), key.cast("string")), "UTF-8"), 256),
                              1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((bits + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, staging: Staging, percent: int = 10, least_words: int = 20,
             longest: int = 1, buckets: int = 10_000, seed: int = 2024, carry: bool = False) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` of every row, and the row itself as
    the struct ``document`` if ``carry``.

    Of the rows with at least ``least_words`` words, floor(percent / 100) of their number are drawn:
    those of the highest score, ties to the smaller id (null last), then by weight and features;
    rows that agree in all of that are interchangeable. ``rank`` counts the drawn from 1 and is
    null for the others. Null and empty texts have no features, weight 0 and are never drawn. An
    empty ``docs`` gives no rows; with an empty ``target`` all its counts are zero. Ranks come from
    range partitions and one offset for each, so no task orders all rows.
    """
    gains = Gains.between(feature_counts(docs, longest, buckets), feature_counts(target, longest, buckets), longest)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), full_text().alias("text"),
                       *([F.struct(*docs.columns).alias("document")] if carry else []))
    score = F.col("weight") + gumbel(F.col("doc_id"), seed)
    scored = weighed(rows, gains).select("doc_id", "n_words", "n_features", "weight", score.alias("score"),
                                         F.monotonically_increasing_id().alias("_tie"), *(["document"] if carry else []))
    scored = staging.put(scored, "scores")
    fits = F.col("n_words") >= least_words
    some = scored.where(fits)
    drawn = some.count() * percent // 100
    if drawn:
        # What cannot be drawn is not numbered: rows below the lowest score that may be.
        low = _least_score(some, drawn, staging)
        some = add_dense_id(scored.where(fits & (F.col("score") >= low)), "rank", [
            F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight").desc(), F.col("n_features").desc(),
            "_tie"], staging)
        rest = scored.where(~fits | (F.col("score") < low))
    else:
        some, rest = scored.where(fits).withColumn("rank", F.lit(None).cast("long")), scored.where(~fits)
    ranked = some.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).unionByName(
        rest.withColumn("rank", F.lit(None).cast("long")))
    return ranked.select("doc_id", "n_features", "weight", "score", "rank", *(["document"] if carry else []))


def _least_score(rows: DataFrame, wanted: int, staging: Staging, cells: int = 1 << 16) -> int:
    """A score that at least ``wanted`` rows reach and hardly more do, from a histogram of ``cells``
    steps between the least and the greatest score."""
    low, high = rows.agg(F.min("score"), F.max("score")).first()
    step = (high - low) // cells + 1
    counts = staging.put(rows.groupBy(((F.col("score") - low) / step).cast("long").alias("cell")).agg(
        F.count(F.lit(1)).alias("n")), "cells")
    downwards = Window.orderBy(F.col("cell").desc()).rowsBetween(Window.unboundedPreceding, 0)
    reached = counts.withColumn("reached", F.sum("n").over(downwards)).where(F.col("reached") >= wanted)
    return int(reached.agg(F.max("cell")).first()[0]) * step + low


def drawn_documents(docs: DataFrame, target: DataFrame, staging: Staging, **how) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns. Nulls, ties and empty tables as in
    ``resample``."""
    return resample(docs, target, staging, carry=True, **how).where("rank IS NOT NULL").select("document.*")
