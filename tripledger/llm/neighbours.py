"""Approximate nearest neighbours with a robust-pruned directed graph for each shard of vectors.

Distinct vectors are dealt to shards by a hash; each shard is indexed by one task. Its graph starts
with random edges; then every node searches the graph greedily for itself, and the nodes that the
search expanded are its proposed neighbours. Relaxed pruning takes the nearest proposal and drops
those that lie ``alpha`` times nearer to it than to the node, and so on, so that the edges that
are left point in different directions; they get edges back, pruned likewise. Nodes that the
graph's entry still does not reach become entries themselves. A query is a beam search in every
shard from its entries; what the beams hold is measured again in double precision and merged.

A shard holds at most about ``shard_rows`` vectors (here 4 KB each with graph and copies), whatever
the table. Indexes are written to the shared folder, a row for each shard, so a lost executor
costs its own shards. Queries go out in blocks of at most ``block_bytes``, each one pass over the
indexes. Equal vectors are one node: only the smallest ``k + 1`` of their ids can be in an answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripledger.staging import Staging

GRID = 1 << 23
INDEX = "dim int, n long, vectors binary, graph binary, entries binary, counts binary, ids binary"


def _distances(vectors: np.ndarray, points: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distances of row i of ``points`` to the nodes in row i of ``ids``."""
    apart = vectors[ids] - points[:, None, :]
    return np.einsum("qcd,qcd->qc", apart, apart)


def search(vectors: np.ndarray, graph: np.ndarray, entries: np.ndarray, points: np.ndarray, beam: int,
           width: int = 4, expanded: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The nodes nearest to each point that a beam search finds, nearest first, -1 where there are
    fewer; and, if asked, all nodes that it expanded.

    All points take a step together: the ``width`` nearest nodes of each beam that are not
    expanded yet give their neighbours, and the nearest ``beam`` of old and new ones stay.
    """
    count, room = len(points), max(beam, len(entries))
    rows = np.arange(count)
    seen = np.zeros((count, len(vectors)), bool)
    ids = np.full((count, room), -1, np.int64)
    near = np.full((count, room), np.inf, np.float32)
    done = np.ones((count, room), bool)
    ids[:, :len(entries)], done[:, :len(entries)] = entries, False
    near[:, :len(entries)] = _distances(vectors, points, ids[:, :len(entries)])
    seen[:, entries] = True
    order = np.argsort(near, axis=1, kind="stable")
    ids, near, done = (np.take_along_axis(x, order, 1) for x in (ids, near, done))
    steps = []
    while len(rows):
        at = np.argsort(done[rows], axis=1, kind="stable")[:, :width]
        spent = np.take_along_axis(done[rows], at, 1)
        live = ~spent.all(axis=1)
        rows, at, spent = rows[live], at[live], spent[live]
        if not len(rows):
            break
        nodes = np.where(spent, -1, np.take_along_axis(ids[rows], at, 1))
        done[rows[:, None], at] = True
        if expanded:
            step = np.full((count, nodes.shape[1]), -1, np.int64)
            step[rows] = nodes
            steps.append(step)
        found = np.where(nodes[:, :, None] >= 0, graph[nodes], -1).reshape(len(rows), -1)
        found.sort(axis=1)
        fresh = found >= 0
        fresh[:, 1:] &= found[:, 1:] != found[:, :-1]
        fresh &= ~seen[rows[:, None], found]
        keep = max(1, int(fresh.sum(axis=1).max()))
        first = np.argsort(~fresh, axis=1, kind="stable")[:, :keep]
        found, fresh = np.take_along_axis(found, first, 1), np.take_along_axis(fresh, first, 1)
        seen[np.broadcast_to(rows[:, None], found.shape)[fresh], found[fresh]] = True
        far = np.where(fresh, _distances(vectors, points[rows], found), np.inf).astype(np.float32)
        all_near = np.concatenate([near[rows], far], axis=1)
        order = np.argsort(all_near, axis=1, kind="stable")[:, :room]
        near[rows] = np.take_along_axis(all_near, order, 1)
        ids[rows] = np.take_along_axis(np.concatenate([ids[rows], np.where(fresh, found, -1)], axis=1), order, 1)
        done[rows] = np.take_along_axis(np.concatenate([done[rows], ~fresh], axis=1), order, 1)
    return ids, np.concatenate(steps, axis=1) if steps else np.empty((count, 0), np.int64)


def _compact(ids: np.ndarray) -> np.ndarray:
    """Rows in order without repeats, filled with -1 at their end, as narrow as they can be."""
    ids = np.sort(ids, axis=1)
    good = ids >= 0
    good[:, 1:] &= ids[:, 1:] != ids[:, :-1]
    first = np.argsort(~good, axis=1, kind="stable")[:, :max(1, int(good.sum(axis=1).max(initial=0)))]
    return np.where(np.take_along_axis(good, first, 1), np.take_along_axis(ids, first, 1), -1)


def prune(vectors: np.ndarray, nodes: np.ndarray, proposed: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """At most ``degree`` of each node's proposed neighbours; -1 fills a row."""
    out = np.full((len(nodes), degree), -1, np.int64)
    proposed = _compact(np.where(proposed == nodes[:, None], -1, proposed))
    block = max(1, GRID // proposed.shape[1] ** 2)
    if len(nodes) > block:
        for at in range(0, len(nodes), block):
            out[at:at + block] = prune(vectors, nodes[at:at + block], proposed[at:at + block], degree, alpha)
        return out
    near = np.where(proposed >= 0, _distances(vectors, vectors[nodes], proposed), np.inf)
    points = vectors[proposed]
    norms = np.einsum("qcd,qcd->qc", points, points)
    apart = norms[:, :, None] + norms[:, None, :] - 2 * (points @ points.transpose(0, 2, 1))
    rows = np.arange(len(nodes))
    for k in range(degree):
        pick = np.argmin(near, axis=1)
        good = np.isfinite(near[rows, pick])
        if not good.any():
            break
        out[good, k] = proposed[rows, pick][good]
        near[(alpha * alpha * apart[rows, pick] <= near) & good[:, None]] = np.inf
        near[rows, pick] = np.inf
    return out


def _link_back(vectors: np.ndarray, graph: np.ndarray, nodes: np.ndarray, degree: int, alpha: float) -> None:
    """Give the edges of ``nodes`` edges in the other direction; rows without room for them are
    pruned to ``degree``."""
    width = graph.shape[1]
    start, end = np.repeat(nodes, width), graph[nodes].ravel()
    start, end = start[end >= 0], end[end >= 0]
    order = np.argsort(end, kind="stable")
    start, end = start[order], end[order]
    owner, begin, number = np.unique(end, return_index=True, return_counts=True)
    for low, high in ((0, width), (width, len(graph))):  # rows of like width together
        own = np.flatnonzero((number > low) & (number <= high))
        if not len(own):
            continue
        at = np.arange(int(number[own].max()))
        more = np.where(at < number[own, None], start[np.minimum(begin[own, None] + at, len(start) - 1)], -1)
        rows = _compact(np.concatenate([graph[owner[own]], more], axis=1))
        full = rows[:, width] >= 0 if rows.shape[1] > width else np.zeros(len(rows), bool)
        fits = rows[~full, :width]
        graph[owner[own[~full]]] = -1
        graph[owner[own[~full]], :fits.shape[1]] = fits
        graph[owner[own[full]]] = -1
        graph[owner[own[full]], :degree] = prune(vectors, owner[own[full]], rows[full], degree, alpha)


def _unreached(graph: np.ndarray, entries: np.ndarray) -> np.ndarray:
    reached = np.zeros(len(graph), bool)
    front = entries
    reached[front] = True
    while len(front):
        after = np.unique(graph[front])
        front = after[(after >= 0) & ~reached[after]]
        reached[front] = True
    return np.flatnonzero(~reached)


def build(vectors: np.ndarray, degree: int = 32, beam: int = 48, alpha: float = 1.2,
          seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Neighbours of every node (-1 fills a row) and the entries, of distinct vectors. Nodes are
    inserted in random order, a block at a time, first with ``alpha`` 1 and then with ``alpha``."""
    n, draw = len(vectors), np.random.default_rng(seed)
    degree = min(degree, max(1, n - 1))
    graph = np.full((n, degree + degree // 2), -1, np.int64)
    drawn = draw.integers(0, max(1, n - 1), (n, degree))
    drawn += drawn >= np.arange(n)[:, None]  # any node but the own
    graph[:, :degree] = np.where(drawn < n, drawn, -1)
    middle = vectors.mean(axis=0)
    entries = np.array([np.argmin(((vectors - middle) ** 2).sum(axis=1))])
    block = max(1, min(512, GRID * 8 // n))
    for relaxed in (1.0, alpha):
        order = draw.permutation(n)
        for at in range(0, n, block):
            nodes = order[at:at + block]
            _, walked = search(vectors, graph, entries, vectors[nodes], beam, expanded=True)
            chosen = prune(vectors, nodes, np.concatenate([walked, graph[nodes]], axis=1), degree, relaxed)
            graph[nodes], graph[nodes, :degree] = -1, chosen
            _link_back(vectors, graph, nodes, degree, relaxed)
    while len(left := _unreached(graph, entries)):
        entries = np.append(entries, left[0])
    return graph.astype(np.int32), entries


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components, and not zero (an empty one is zero)."""
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~wrong & F.exists(vector, lambda x: x != 0), F.lit(False))


def _flat(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False)


def _merged(vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct vectors, how many ids each has, and these: the ``k + 1`` smallest of its rows."""
    whole = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.itemsize * vectors.shape[1]))).ravel()
    _, first, which = np.unique(whole, return_index=True, return_inverse=True)
    order = np.lexsort((ids, which))
    which, ids = which[order], ids[order]
    once = np.ones(len(ids), bool)
    once[1:] = (which[1:] != which[:-1]) | (ids[1:] != ids[:-1])
    which, ids = which[once], ids[once]
    kept = np.arange(len(ids)) - np.searchsorted(which, which) <= k
    return vectors[first], np.bincount(which[kept], minlength=len(first)), ids[kept]


def _collapsed(k: int, kind):
    """One row for each vector of a batch, so that copies are cut before they are shuffled."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                vectors = _flat(part.column("vector")).reshape(-1, dim)
                distinct, counts, ids = _merged(vectors, part.column("id").to_numpy(), k)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(distinct), dim, np.int32)),
                    pa.ListArray.from_arrays(np.arange(len(distinct) + 1, dtype=np.int32) * np.int32(dim),
                                             pa.array(distinct.ravel(), kind)),
                    pa.ListArray.from_arrays(np.append(0, np.cumsum(counts)).astype(np.int32), ids)],
                    names=["dim", "vector", "ids"])
    return work


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Rows that follow each other with one dimension and shard."""
    key, parts = None, []
    for batch in batches:
        dims, shards = (batch.column(c).to_numpy() for c in ("dim", "shard"))
        cuts = [0, *(np.flatnonzero((np.diff(dims) != 0) | (np.diff(shards) != 0)) + 1).tolist(), len(dims)]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if lo < hi:
                if key != (now := (int(dims[lo]), int(shards[lo]))):
                    if parts:
                        yield key[0], parts
                    key, parts = now, []
                parts.append(batch.slice(lo, hi - lo))
    if parts:
        yield key[0], parts


def index(rows: DataFrame, staging: Staging, k: int, shard_rows: int, degree: int, beam: int,
          alpha: float) -> DataFrame:
    """The written indexes of ``id`` and ``vector``, one row for each shard.

    Every vector is indexed. The ids of equal vectors are cut to the ``k + 1`` smallest, first in
    every batch before the shuffle: of a vector's copies no answer holds more than ``k``, and the
    query's own id is at most one of the others.
    """
    kind = rows.schema["vector"].dataType
    shards = max(1, -(-rows.count() // shard_rows))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, parts in _shards(batches):
            times = np.concatenate([np.diff(p.column("ids").offsets.to_numpy()) for p in parts])
            vectors = np.concatenate([_flat(p.column("vector")) for p in parts]).reshape(-1, dim)
            ids = np.concatenate([_flat(p.column("ids")) for p in parts])
            exact, counts, ids = _merged(np.repeat(vectors, times, axis=0), ids, k)
            graph, entries = build(_scaled(exact)[0], degree, beam, alpha)
            yield pa.RecordBatch.from_pylist([{
                "dim": dim, "n": len(exact), "vectors": exact.tobytes(), "graph": graph.tobytes(),
                "entries": entries.tobytes(), "counts": counts.tobytes(), "ids": ids.tobytes()}], schema=schema)

    schema = pa.schema([("dim", pa.int32()), ("n", pa.int64()), *((c, pa.binary()) for c in (
        "vectors", "graph", "entries", "counts", "ids"))])
    element = pa.float32() if kind.elementType == T.FloatType() else pa.float64()
    local = rows.withColumn("dim", F.size("vector")).mapInArrow(
        _collapsed(k, element), f"dim int, vector {kind.simpleString()}, ids array<long>")
    dealt = local.withColumn("shard", F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int")).repartition(
        shards, "dim", "shard").sortWithinPartitions("dim", "shard")
    return staging.put(dealt.mapInArrow(work, INDEX), "indexes")


def _scaled(exact: np.ndarray) -> tuple[np.ndarray, float]:
    """Vectors as 32-bit numbers, scaled so that squares neither overflow nor vanish."""
    scale = float(np.abs(exact).max())
    return (exact / scale).astype(np.float32), scale


def _exact(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, added up in the order of the components."""
    total = np.zeros(len(points))
    for j in range(points.shape[1]):
        total += (points[:, j] - others[:, j].astype(np.float64)) ** 2
    return np.sqrt(total)


def _block_search(queries: dict[int, tuple[int, np.ndarray, np.ndarray]], k: int, beam: int, kind):
    """The best ``k`` of each index for each query of a block: by dimension the number of its first
    query, ids and vectors."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                first, own, points = queries.get(r["dim"], (0, (), ()))
                exact = np.frombuffer(r["vectors"], kind).reshape(r["n"], r["dim"])
                vectors, scale = _scaled(exact)
                graph = np.frombuffer(r["graph"], np.int32).reshape(r["n"], -1)
                entries, counts, ids = (np.frombuffer(r[c], np.int64) for c in ("entries", "counts", "ids"))
                begins = np.cumsum(counts) - counts
                step = max(1, min(512, GRID * 8 // r["n"]))
                for at in range(0, len(own), step):
                    near = points[at:at + step]
                    found, _ = search(vectors, graph, entries, (near / scale).astype(np.float32), beam)
                    query, col = np.nonzero(found >= 0)
                    node = found[query, col]
                    far, times = _exact(near[query], exact[node]), counts[node]
                    before = np.cumsum(times) - times
                    vec = ids[np.repeat(begins[node] - before, times) + np.arange(times.sum())]
                    query, far = np.repeat(query, times), np.repeat(far, times)
                    other = vec != own[at:at + step][query]
                    query, far, vec = query[other], far[other], vec[other]
                    order = np.lexsort((vec, far, query))
                    query, far, vec = query[order], far[order], vec[order]
                    best = np.arange(len(query)) - np.searchsorted(query, query) < k
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own[at:at + step][query[best]]), pa.array(first + at + query[best]),
                         pa.array(vec[best]), pa.array(far[best])], names=["query_id", "place", "vec_id", "score"])
    return work


def nearest(rows: DataFrame, queries: DataFrame, staging: Staging, k: int = 10, shard_rows: int = 8192,
            degree: int = 32, beam: int = 64, build_beam: int = 48, alpha: float = 1.2,
            block_bytes: int = 16 << 20) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` nearest rows found for every query.

    Both frames have ``id`` and ``vector``. Nearness is the Euclidean distance in double precision;
    ties go to the smaller id. Vectors that are null, zero or empty, or hold null or non-finite
    components, and rows without an id, take no part on either side. Only vectors of equal length
    are compared. Rows with a query's id are its own and no answer to it. Repeated rows count once;
    a query id with several vectors is a query with each. With fewer than ``k`` other rows all are
    returned, and an empty table gives no rows.
    """
    kind = "array<float>" if rows.schema["vector"].dataType == T.ArrayType(T.FloatType()) else "array<double>"

    def clean(df: DataFrame, kind: str) -> DataFrame:
        whole = df.select(F.col("id").cast("long").alias("id"), F.col("vector").cast(kind).alias("vector"))
        # Adding zero makes the two zeros one, so that equal vectors have equal bytes.
        return whole.where(F.col("id").isNotNull() & usable(F.col("vector"))).withColumn(
            "vector", F.transform("vector", lambda x: x + F.lit(0.0)).cast(kind))

    indexes = index(clean(rows, kind), staging, k, shard_rows, degree, build_beam, alpha)
    asked = staging.put(clean(queries, "array<double>").distinct().withColumn("dim", F.size("vector")), "queries")
    size = asked.agg(F.coalesce(F.sum(F.col("dim") * 8 + 64), F.lit(0))).first()[0]
    blocks = max(1, -(-size // (block_bytes // 2)))
    found = None
    for block in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)) == block).orderBy("dim", "id", "vector")
        held: dict[int, tuple[int, list, list]] = {}
        for number, r in enumerate(part.toLocalIterator()):  # a block, of bounded size
            _, own, points = held.setdefault(r.dim, (number, [], []))
            own.append(r.id)
            points.append(r.vector)
        arrays = {dim: (first, np.array(own, np.int64), np.array(points)) for dim, (first, own, points) in held.items()}
        hits = indexes.mapInArrow(_block_search(arrays, k, beam, np.float32 if "float" in kind else np.float64),
                                  "query_id long, place long, vec_id long, score double")
        hits = hits.select(F.lit(block).alias("block"), "*")
        found = hits if found is None else found.unionByName(hits)
    order = Window.partitionBy("query_id", "block", "place").orderBy("score", "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
