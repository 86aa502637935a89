"""SimHash near duplicates by covering locality-sensitive hashing.

A text's fingerprint has a bit set where more than half of its shingles' hashes have it. Two
fingerprints link when at most ``radius`` bits differ. Every bit position gets a random vector
of ``radius + 1`` bits, and every non-zero vector v of that length makes one table, whose mask
holds the positions with an odd inner product with v. The vectors of ``radius`` differing bits
never span the whole space, so some v is orthogonal to all of them: every linked pair agrees on
that table's mask and shares its bucket. No link is lost, whatever the fingerprints are.

Equal fingerprints are one node, so copies add nothing. A bucket gives the edges of a spanning
forest of its links, never its pairs; one that is too large to compare pair by pair is covered
again by the masks of other random vectors, inside its task. Memory is 8 bytes for each distinct
fingerprint of the largest bucket.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger.llm.common import full_text, without
from tripledger.llm.graph import components
from tripledger.staging import Staging

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
CHUNK = 1 << 16
PAIRWISE = 2048


def fingerprint(text: str, width: int, seed: int = 42) -> int:
    """64 bits: those set in over half of the shingles' XXH64. Repeated shingles count each time.

    Fewer than ``width`` words make one shingle; no word gives zero.
    """
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words]).tolist()
    ends = (ends - 1).tolist()[min(width, len(words)) - 1:]
    total, votes, digest = len(ends), np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, total, CHUNK):
        part = ends[at:at + CHUNK]
        hashes = np.fromiter((digest(joined[s:e], seed) for s, e in zip(starts[at:], part)),
                             np.uint64, len(part))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(votes * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """``doc_id``, ``text_key`` (hash of the text) and ``fp`` for every row; null text is empty."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), width) for t in batch.column("text")),
                              np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(fps.view(np.int64))],
                names=["doc_id", "text_key", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), full_text().alias("text"),
                       F.xxhash64(full_text()).alias("text_key"))
    return rows.mapInArrow(work, "doc_id long, text_key long, fp long")


def masks(radius: int, seed: int, bits: int = 64) -> list[int]:
    """The 2^(radius+1) - 1 covering masks, as signed 64-bit numbers."""
    draw = random.Random(seed)
    vectors = [draw.randrange(1, 1 << (radius + 1)) for _ in range(bits)]
    found = []
    for v in range(1, 1 << (radius + 1)):
        mask = sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() & 1)
        found.append(mask - (1 << 64) if mask >> 63 else mask)
    return found


def forest(fps: np.ndarray, radius: int, depth: int = 0) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges that connect what is linked among distinct fingerprints of one bucket."""
    if len(fps) > PAIRWISE and depth < 8:
        edges = []
        for mask in masks(radius, seed=1000 + depth):
            keys = fps & np.uint64(mask & (1 << 64) - 1)
            order = np.argsort(keys, kind="stable")
            cuts = np.flatnonzero(np.diff(keys[order])) + 1
            if len(cuts) == 0:  # the mask tells nothing apart here
                edges += forest(fps, radius, depth=8)
                break
            for part in np.split(fps[order], cuts):
                if len(part) > 1:
                    edges += forest(part, radius, depth + 1)
        return edges
    left = np.sort(fps)
    edges = []
    while len(left):  # a breadth-first walk from the first node not reached yet
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            reached = np.full(len(left), -1, np.int64)
            for i, node in enumerate(front):
                near = np.bitwise_count(left ^ node) <= radius
                reached[near & (reached < 0)] = i
            hit = reached >= 0
            if hit.any():
                edges.append((front[reached[hit]], left[hit]))
            front, left = left[hit], left[~hit]
    return edges


def links(fps: DataFrame, radius: int = 4, seed: int = 7) -> DataFrame:
    """Edges (a, b) of spanning forests of the links between distinct ``fp``."""
    covering = masks(radius, seed)
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m)))
                     for i, m in enumerate(covering)])
    buckets = fps.select("fp").distinct().select("fp", F.explode(keys).alias("bucket"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def of(bucket: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            same = np.flatnonzero(bucket[1:] == bucket[:-1])
            edges = []
            if len(same):
                cuts = np.flatnonzero(np.diff(bucket)) + 1
                bounds = np.concatenate([[0], cuts, [len(bucket)]])
                sizes = np.diff(bounds)
                pairs = bounds[:-1][sizes == 2]
                near = np.bitwise_count(fp[pairs] ^ fp[pairs + 1]) <= radius
                edges.append((fp[pairs[near]], fp[pairs[near] + 1]))
                for k in np.flatnonzero(sizes > 2):
                    edges += forest(fp[bounds[k]:bounds[k + 1]], radius)
            a = np.concatenate([e[0] for e in edges]) if edges else np.empty(0, np.uint64)
            b = np.concatenate([e[1] for e in edges]) if edges else np.empty(0, np.uint64)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            bucket = batch.column("bucket").to_numpy(zero_copy_only=False)
            fp = batch.column("fp").to_numpy(zero_copy_only=False)
            held.append((bucket, fp.view(np.uint64)))  # NumPy counts the bits of unsigned numbers
            if len(bucket) and held[0][0][0] != bucket[-1]:  # only the last bucket may go on
                bucket, fp = (np.concatenate(x) for x in zip(*held))
                at = np.searchsorted(bucket, bucket[-1])
                yield of(bucket[:at], fp[:at])
                held = [(bucket[at:], fp[at:])]
        if held:
            yield of(*(np.concatenate(x) for x in zip(*held)))

    ordered = buckets.repartition("bucket").sortWithinPartitions("bucket")
    return ordered.mapInArrow(work, "a long, b long").distinct()


def classes(docs: DataFrame, staging: Staging, width: int = 4, radius: int = 4) -> DataFrame:
    """``doc_id``, ``text_key``, ``fp``, ``component_id`` and ``keeper`` for every row.

    ``component_id`` is the smallest doc_id reachable over links (a null id counts only where
    there is no other). ``keeper`` marks the row that stands for its component: the smallest id,
    then the smallest hash of the text; rows that repeat both are one document and share the mark.
    Empty texts have fingerprint zero and link like any other. An empty table gives no rows.
    """
    rows = staging.put(fingerprints(docs, width), "fingerprints")
    roots = components(links(rows, radius), staging)
    placed = rows.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    placed = staging.put(placed, "placed")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "text_key"))
    heads = placed.groupBy("root").agg(best.alias("head"))
    joined = placed.join(heads, "root")
    keeper = (F.col("doc_id").eqNullSafe(F.col("head.doc_id"))
              & (F.col("text_key") == F.col("head.text_key")))
    return joined.select("doc_id", "text_key", "fp", F.col("head.doc_id").alias("component_id"),
                         keeper.alias("keeper"))


def drop_near_copies(docs: DataFrame, staging: Staging, width: int = 4,
                     radius: int = 4) -> DataFrame:
    """The rows of ``docs`` that stand for their component, with all their columns. Nulls, empty
    texts and repeated rows as in ``classes``; an empty table gives no rows."""
    gone = classes(docs, staging, width, radius).where(~F.col("keeper"))
    return without(docs, gone.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key")), staging)
