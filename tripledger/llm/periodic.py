"""Runs of repeated words: stretches that have a period and go on for several of it.

The periods of a document fall into octaves [s, 2s). A run of period q in one of them, at least
three periods long, has a multiple b of s among its first q words, so that the words from b on
equal those from b + q on for a known distance. The document is exploded into tiles for each octave
that such equalities occur in: a tile has the boundaries of at least eight scales, and the words
around them. Tiles are dealt out by document, octave and place, and solved by themselves: at a
boundary, Z-functions of the words after it and of the reversed words before it tell how far each
period of the octave goes in both directions, and whether a smaller period explains it. That gives
fragments, cut where the tile ends. Fragments of a document and period that overlap by a period
belong to one run (two stretches of one period that share so much have it together), so grouping by
document and period and joining overlaps gives the runs.

Which tiles are needed is asked with prefix hashes: equal words have equal hashes, so none is missed;
what the hashes let through by mistake is refused by the Z-functions. Results are exact. A tile
holds about ``tile`` words or fifteen scales, of 4 bytes; a text itself is held by one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripledger.llm.common import full_text
from tripledger.llm.tokens import mixed
from tripledger.staging import Staging

TILE = 4096
GRID = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def least_length(q: int, least: int, times: int) -> int:
    return max(least, times * q)


def _numbered(words: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words))


def candidates(ids: np.ndarray, s: int, begin: int, end: int, longest: int, least: int,
               times: int) -> tuple[np.ndarray, np.ndarray]:
    """Boundaries b = begin, begin + s, … below ``end`` and periods q of the octave of s, up to
    ``longest``, for which the words from b and from b + q on agree as far as a run must go on from
    its first boundary. None is missed."""
    q = np.arange(s, min(2 * s, longest + 1))
    b = np.arange(begin, end, s)
    same = np.maximum(least, times * q) - q - s + 1  # a boundary is at most s - 1 words into the run
    none = np.empty(0, np.int64)
    if not len(q) or not len(b):
        return none, none
    found = []
    rows = max(1, GRID // len(q))
    for at in range(0, len(b), rows):
        part = b[at:at + rows, None]
        other = part + q
        inside = other + same <= len(ids)
        hit = np.nonzero(inside & (ids[part] == ids[np.minimum(other, len(ids) - 1)]))
        if len(hit[0]):
            found.append((part[hit[0], 0], q[hit[1]], same[hit[1]]))
    if not found:
        return none, none
    b, q, same = (np.concatenate(x) for x in zip(*found))
    codes = mixed(ids.astype(np.uint64) + np.uint64(1))
    powers = np.full(len(ids) + 1, BASE, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(codes * powers[:-1], dtype=np.uint64)])
    equal = (sums[b + same] - sums[b]) * powers[q] == sums[b + q + same] - sums[b + q]
    return b[equal], q[equal]


def z_function(u: list[int]) -> list[int]:
    """For each position how many numbers from there on equal those from the beginning on."""
    n = len(u)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and u[k] == u[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _forward(ids: list[int], b: int, periods: list[int], s: int) -> dict[int, int]:
    """For the periods that no smaller one explains, how far the period goes after boundary b."""
    size = 8 * s + 48
    while True:
        z = z_function(ids[b:b + size])
        reach = 0  # of all shorter shifts: a shift of d has d as a period up to d + z[d]
        ends, d = {}, 1
        for q in periods:
            while d < q:
                reach = max(reach, d + z[d])
                d += 1
            if reach < 2 * q:
                ends[q] = b + q + z[q]
        if b + size >= len(ids) or all(e < b + size for e in ends.values()):
            return ends
        size *= 2


def _backward(ids: list[int], b: int, periods: list[int], s: int) -> dict[int, int]:
    """Where the periods' stretches begin that cover boundary b."""
    size, top = 2 * s, min(len(ids), b + 2 * s)
    while True:
        low = max(0, b - size)
        before = ids[low:b][::-1]
        z = z_function([*before, -1, *ids[low:top][::-1]])
        begins = {q: b - z[len(before) + 1 + top - b - q] for q in periods}
        if low == 0 or all(i > low for i in begins.values()):
            return begins
        size *= 4


def solve(ids: np.ndarray, s: int, begin: int, end: int, longest: int, least: int,
          times: int) -> list[tuple[int, int, int]]:
    """Fragments (period, start, end) of the runs at the boundaries of a tile."""
    b, q = candidates(ids, s, begin, end, longest, least, times)
    known: dict[int, int] = {}
    words, found = ids.tolist(), []
    cuts = np.flatnonzero(np.diff(b, prepend=-1))
    for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(b)]):
        at = int(b[lo])
        # What a fragment covers as far as a run must go on from here is that fragment's.
        new = [p for p in q[lo:hi].tolist() if at + least_length(p, least, times) - s + 1 > known.get(p, -1)]
        if not new:
            continue
        ends = _forward(words, at, new, s)
        ends = {p: e for p, e in ends.items() if e >= at + least_length(p, least, times) - s + 1}
        if not ends:
            continue
        for p, start in _backward(words, at, list(ends), s).items():
            known[p] = ends[p]
            found.append((p, start, ends[p]))
    return found


def octaves(n: int, times: int) -> Iterator[int]:
    s = 1
    while times * s <= n:
        yield s
        s *= 2


def tiles(ids: np.ndarray, least: int, times: int, tile: int = TILE) -> Iterator[tuple[int, int, int, int, int]]:
    """(s, low, high, begin, end): words [low, high) and boundaries [begin, end) of each tile that
    holds an equality."""
    n = len(ids)
    if n < least:
        return
    for s in octaves(n, times):
        b, _ = candidates(ids, s, 0, n, n // times, least, times)
        if len(b):
            core = max(tile, 8 * s) // s * s
            margin = max(least, 2 * times * s)
            for k in np.unique(b // core).tolist():
                begin, end = k * core, min(n, (k + 1) * core)
                yield s, max(0, begin - s), min(n, end + margin), begin, end


def _joined(words: list[bytes]) -> tuple[str, str]:
    text = b" ".join(words)
    return text.decode("utf-8"), hashlib.sha256(text).hexdigest()


def _suspects(least: int, times: int):
    """The digest of each text's words, and the words themselves where it may hold a run."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for k, value in enumerate(batch.column("text")):
                words = value.as_buffer().to_pybytes().split()
                text, digest = _joined(words)
                may = next(tiles(_numbered(words), least, times), None) is not None if len(words) >= least else False
                held.append((k, len(words), digest, text if may else None))
                size += 200 + (len(text) if may else 0)
                if size > 4 << 20 or k == batch.num_rows - 1:
                    rows, n, digests, texts = zip(*held)
                    at = pa.array(rows, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(at), batch.column("text_key").take(at), pa.array(n, pa.int64()),
                         pa.array(digests), pa.array(texts, pa.string())],
                        names=["doc_id", "text_key", "n_words", "digest", "words"])
                    held, size = [], 0
    return work


def _exploded(least: int, times: int, tile: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist()
            rows, size = [], 0
            for doc_id, key, value in zip(ids, keys, batch.column("words")):
                numbers = _numbered(value.as_buffer().to_pybytes().split())
                for s, low, high, begin, end in tiles(numbers, least, times, tile):
                    rows.append((doc_id, key, s, low, begin - low, end - low, len(numbers) // times,
                                 numbers[low:high].tobytes()))
                    size += 4 * (high - low)
                    if size > 4 << 20:
                        yield _batch(rows, TILES)
                        rows, size = [], 0
            if rows:
                yield _batch(rows, TILES)
    return work


def _solved(least: int, times: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            numbers = zip(*(batch.column(c).to_pylist() for c in TILES.names[:-1]))
            for (doc_id, key, s, low, begin, end, longest), body in zip(numbers, batch.column("body")):
                ids = np.frombuffer(body.as_buffer(), np.int32)
                rows += [(doc_id, key, q, low + i, low + j)
                         for q, i, j in solve(ids, s, begin, end, longest, least, times)]
            yield _batch(rows, FRAGMENTS)
    return work


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_LONG = ("doc_id", "text_key")
TILES = pa.schema([*((c, pa.int64()) for c in (*_LONG, "s", "low", "begin", "end", "longest")), ("body", pa.binary())])
FRAGMENTS = pa.schema([(c, pa.int64()) for c in (*_LONG, "period", "start", "stop")])


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'binary' if pa.types.is_binary(f.type) else 'long'}" for f in schema)


def stitched(fragments: DataFrame, least: int, times: int) -> DataFrame:
    """``doc_id``, ``text_key``, ``start``, ``length`` and ``period`` of the runs."""
    key = ["doc_id", "text_key", "period"]
    order = Window.partitionBy(*key).orderBy("start", "stop")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((F.col("start") > before - F.col("period")).cast("int"), F.lit(1))
    part = F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0))
    runs = fragments.distinct().withColumn("_opens", opens).withColumn("_part", part).groupBy(*key, "_part").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"))
    return runs.select("doc_id", "text_key", "start", (F.col("stop") - F.col("start")).alias("length"), "period").where(
        (F.col("length") >= least) & (F.col("length") >= times * F.col("period")))


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words that a run holds after its first period go."""
    for batch in batches:
        texts, digests = [], []
        for value, runs in zip(batch.column("words"), batch.column("runs")):
            words = value.as_buffer().to_pybytes().split()
            if runs.is_valid:
                kept = np.ones(len(words) + 1, np.int64)
                change = np.zeros(len(words) + 1, np.int64)
                for r in runs.as_py():
                    change[r["start"] + r["period"]] += 1
                    change[r["start"] + r["length"]] -= 1
                kept = np.flatnonzero(np.cumsum(change)[:-1] == 0)
                words = [words[i] for i in kept.tolist()]
            text, digest = _joined(words)
            texts.append(text)
            digests.append(digest)
        columns = [batch.column(c) for c in ("doc_id", "text_key", "n_words", "runs")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string()), pa.array(digests, pa.string())],
                                         names=["doc_id", "text_key", "n_words", "runs", "collapsed", "digest"])


RUNS = "array<struct<start:bigint,period:bigint,length:bigint>>"


def find(docs: DataFrame, staging: Staging, least: int = 24, times: int = 3, tile: int = TILE) -> DataFrame:
    """``doc_id``, ``text_key`` (hash of the text), ``n_words``, ``runs``, ``collapsed`` and ``digest`` per row.

    A run is a stretch of words with the smallest period q, at least ``times`` periods and ``least``
    words long, that no neighbouring word extends; ``times`` is 3 or more. ``runs`` has all of them
    by start and period (empty without any). ``collapsed`` is the text without the words that a run
    holds after its first q words, joined by single spaces, and null for a text that may not hold a
    run at all; ``digest`` is the SHA-256 of the words that stay, for every row. Null text is empty
    and has no words. Rows that repeat id and text have the same results. An empty table gives no
    rows. The runs of one document are held together, which its own words bound.
    """
    if times < 3:
        raise ValueError("times must be 3 or more")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(full_text()).alias("text_key"),
                       full_text().alias("text"))
    seen = staging.put(rows.mapInArrow(_suspects(least, times), "doc_id long, text_key long, n_words long, "
                                                                "digest string, words string"), "suspects")
    some = seen.where("words IS NOT NULL")
    laid = some.select("doc_id", "text_key", "words").mapInArrow(_exploded(least, times, tile), _ddl(TILES))
    dealt = laid.repartition("doc_id", "text_key", "s", "low")
    runs = stitched(dealt.mapInArrow(_solved(least, times), _ddl(FRAGMENTS)), least, times)
    lists = runs.groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    lists = staging.put(lists.toDF("_id", "_key", "runs"), "runs")
    joined = some.join(lists, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    done = joined.select("doc_id", "text_key", "n_words", "words", "runs").mapInArrow(
        _collapse, f"doc_id long, text_key long, n_words long, runs {RUNS}, collapsed string, digest string")
    empty = F.array().cast(RUNS)
    return done.withColumn("runs", F.coalesce("runs", empty)).unionByName(
        seen.where("words IS NULL").select("doc_id", "text_key", "n_words", empty.alias("runs"),
                                           F.lit(None).cast("string").alias("collapsed"), "digest"))
