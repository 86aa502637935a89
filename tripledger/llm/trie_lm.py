"""Trigram language model in an Elias-Fano trie of memory-mapped levels.

The vocabulary is the first level: word hashes in order, whose ranks are the ids, with exact
counts. A node of the second level is a word after a context word, stored as the monotone number
context * universe + id; pointers give the place where a context's words begin. A node of the
third level is a word after a second-level node, stored not by its id but by its place among the
words that follow the middle word alone, which is a smaller number. A lookup is thus a successor
search in a sequence, then one relative to the shorter context. Pointers and keys are Elias-Fano
sequences, probabilities and back-off weights are 16-bit codes of 1/4096 of a decade.

Smoothing is interpolated absolute discounting over add-one-half unigrams, so every context's
probabilities add up to one (up to the codes). There is one discount for each order, from the
numbers of n-grams seen once and twice in all shards together, so that scores do not depend on how
the levels are cut.

Counts of all training texts are gathered; nothing is pruned. Levels are cut into shards of about
``shard_bytes`` of text by ranges of the context id, written to the shared folder and mapped by
the tasks that score, so memory is that of the pages a task touches. One shuffle carries packed
counts, a row for each slice of ``SLICE`` bytes of text and shard; what follows reads the merged
counts of a shard where they were written. All n-grams that begin with one word are in one shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.llm.common import full_text
from tripledger.llm.eliasfano import EliasFano, load, mapped_for, save
from tripledger.llm.tokens import VISIBLE, mixed, slices, words
from tripledger.staging import Staging

END = mixed(np.array([1], np.uint64))[0]
STEP = 4096
SLICE = 4 << 20
CODEC = "zstd"


def _pack(a: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(a).view(np.uint8), codec=CODEC, asbytes=True)


def _unpack(data: bytes, n: int, kind) -> np.ndarray:
    size = n * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(data, size, codec=CODEC, asbytes=True), kind) if n else np.empty(0, kind)


def _steps(sorted_keys: np.ndarray) -> np.ndarray:
    return np.diff(sorted_keys, prepend=np.uint64(0))


def _code(p: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-np.log10(np.maximum(p, 1e-15)) * STEP), 0, 65535).astype(np.uint16)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, their total counts, and where each input key went."""
    found, which = np.unique(keys, return_inverse=True)
    return found, np.bincount(which, counts, len(found)).astype(np.int64), which


def _discount(once: int, twice: int) -> float:
    return min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5


def sequence(hashes: np.ndarray, cuts: np.ndarray, ids, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a slice's rows, each as begin, words, end; and the bounds of the rows in it."""
    rows = len(cuts) - 1
    out = np.empty(len(hashes) + 2 * rows, np.int64)
    row_of = np.repeat(np.arange(rows), np.diff(cuts))
    unique, which = np.unique(np.append(hashes, END), return_inverse=True)
    known = ids(unique)
    out[np.arange(len(hashes)) + 2 * row_of + 1] = known[which[:-1]]
    bounds = cuts + 2 * np.arange(rows + 1)
    out[bounds[:-1]] = begin
    out[bounds[1:] - 1] = known[which[-1]]
    return out, bounds


@dataclass
class Vocabulary:
    paths: list[str | None]
    offsets: list[int]
    bits: int
    size: int
    tokens: int

    def begin(self) -> None:
        """Called by every task that maps files of this model."""
        mapped_for(next((p for p in self.paths if p), None))

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of hashes, which are in order; -1 for words that were not learned."""
        found = np.full(len(hashes), -1, np.int64)
        shard = (hashes >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(hashes), np.int64)
        cuts = np.searchsorted(shard, np.arange(len(self.paths) + 1))
        rest = np.uint64((1 << 64 - self.bits) - 1)
        for s in np.unique(shard):
            if self.paths[s]:
                lo, hi = cuts[s], cuts[s + 1]
                at = load(self.paths[s])["hash"].locate(hashes[lo:hi] & rest)
                found[lo:hi] = np.where(at >= 0, at + self.offsets[s], -1)
        return found

    def counts(self, ids: np.ndarray) -> np.ndarray:
        unique, which = np.unique(ids, return_inverse=True)
        found = np.zeros(len(unique), np.int64)
        cuts = np.searchsorted(unique, [*self.offsets, self.size])
        for s, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
            if lo < hi:
                found[lo:hi] = load(self.paths[s])["count"][unique[lo:hi] - self.offsets[s]]
        return found[which]

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.5) / (self.tokens + 0.5 * (self.size + 1))


def _located(sequence: EliasFano, keys: np.ndarray) -> np.ndarray:
    """Positions of keys, each looked up once and in order."""
    unique, which = np.unique(keys.astype(np.uint64), return_inverse=True)
    return sequence.locate(unique)[which]


@dataclass
class Levels:
    """Second and third level by shard; shard s has the contexts from ``bounds[s]`` on."""
    vocabulary: Vocabulary
    bounds: list[int]
    second: list[str | None]
    third: list[str | None]

    def by_shard(self, contexts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        shard = np.searchsorted(self.bounds, contexts, side="right") - 1
        order = np.argsort(shard, kind="stable")
        cuts = np.flatnonzero(np.diff(shard[order], prepend=-2))
        for part in np.split(order, cuts[1:]) if len(order) else []:
            s = int(shard[part[0]])
            if s >= 0 and self.second[s]:
                yield s, part[contexts[part] >= 0]

    def pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For contexts ``a`` and words ``b``: the node (or -1), its place among the words after
        ``a``, and the code of its probability, or of the back-off weight where it is absent."""
        node, place, code = (np.full(len(a), -1, np.int64), np.full(len(a), -1, np.int64),
                             np.zeros(len(a), np.int64))
        for s, own in self.by_shard(a):
            level, first = load(self.second[s]), a[own] - self.bounds[s]
            known = b[own] >= 0
            at = np.full(len(own), -1, np.int64)
            key = first[known] * (self.vocabulary.size + 1) + b[own][known]
            at[known] = _located(level["key"], key)
            hit = at >= 0
            node[own], code[own] = at, level["back"][first]
            code[own[hit]] = level["prob"][at[hit]]
            place[own[hit]] = at[hit] - level["start"].get(first[hit]).astype(np.int64)
        return node, place, code

    def score(self, tokens: np.ndarray, bounds: np.ndarray, base: np.ndarray | None = None) -> np.ndarray:
        """log10 probability of each token after its context, 0 for the begin marks. ``base`` has
        those of the tokens without a context, where they are known."""
        out = np.zeros(len(tokens))
        begin = np.zeros(len(tokens), bool)
        begin[bounds[:-1]] = True
        at = np.flatnonzero(~begin)
        if not len(at):
            return out
        b, c = tokens[at - 1], tokens[at]
        base = np.log10(self.vocabulary.unigram(self.vocabulary.counts(c))) if base is None else base[at]
        node, place, code = self.pairs(b, c)
        value = np.where(node >= 0, 0.0, base) - code / STEP
        every = np.full(len(tokens), -1, np.int64)
        every[at] = node
        longer = np.flatnonzero(~begin[at - 1])  # tokens with two before them
        upper = every[at[longer] - 1]
        longer, upper = longer[upper >= 0], upper[upper >= 0]
        first = tokens[at[longer] - 2]
        for s, own in self.by_shard(first):
            t, u = longer[own], upper[own]
            weight = load(self.second[s])["back2"][u].astype(np.int64)
            level = load(self.third[s])
            found = np.full(len(own), -1, np.int64)
            known = place[t] >= 0
            key = u[known] * int(level["room"][0]) + place[t][known]
            inside = place[t][known] < int(level["room"][0])
            found[known] = np.where(inside, _located(level["key"], key), -1)
            hit = found >= 0
            value[t[~hit]] -= weight[~hit] / STEP
            value[t[hit]] = -level["prob"][found[hit]].astype(np.int64) / STEP
        out[at] = value
        return out


# ---- learning --------------------------------------------------------------------------

def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """Rows that follow each other with one ``shard``."""
    shard, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["shard"] != shard:
                if rows:
                    yield shard, rows
                shard, rows = row["shard"], []
            rows.append(row)
    if rows:
        yield shard, rows


def _dealt(df: DataFrame, shards: int) -> DataFrame:
    return df.repartition(shards, "shard").sortWithinPartitions("shard")


def _vocabulary(texts: DataFrame, bits: int, staging: Staging) -> Vocabulary:
    folder = staging.path("vocabulary")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, bounds in slices(batch.column("text")):
                hashes, cuts = words(data, bounds, VISIBLE)
                keys, n = np.unique(hashes, return_counts=True)
                keys, n = np.append(keys, END), np.append(n, len(cuts) - 1)  # an end each
                order = np.argsort(keys)
                keys, n = keys[order], n[order]
                shard = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
                at = np.searchsorted(shard, np.arange((1 << bits) + 1))
                own = [s for s in range(1 << bits) if at[s] < at[s + 1]]
                yield pa.RecordBatch.from_arrays([
                    pa.array(own, pa.int64()), pa.array([int(at[s + 1] - at[s]) for s in own], pa.int64()),
                    pa.array([keys[at[s]:at[s + 1]].tobytes() for s in own], pa.binary()),
                    pa.array([_pack(n[at[s]:at[s + 1]].astype(np.int64)) for s in own], pa.binary())],
                    names=["shard", "n", "keys", "counts"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _grouped(batches):
            keys, n, _ = _summed(
                np.concatenate([np.frombuffer(r["keys"], np.uint64) for r in rows]),
                np.concatenate([_unpack(r["counts"], r["n"], np.int64) for r in rows]))
            path = f"{folder}/{shard}-{np.random.default_rng().integers(1 << 62):x}"
            rest = keys & np.uint64((1 << 64 - bits) - 1)
            save(path, {"hash": EliasFano.encode(rest, 1 << 64 - bits),
                        "count": n.astype(np.uint32 if n.max() < 1 << 32 else np.uint64)})
            yield pa.RecordBatch.from_pylist([{"shard": shard, "path": path, "n": len(keys), "tokens": int(n.sum())}])

    counted = texts.mapInArrow(count, "shard long, n long, keys binary, counts binary")
    made = _dealt(counted, 1 << bits).mapInArrow(write, "shard long, path string, n long, tokens long").collect()
    paths, sizes = [None] * (1 << bits), np.zeros(1 << bits, np.int64)
    for r in made:  # one small row per shard
        paths[r.shard], sizes[r.shard] = r.path, r.n
    offsets = (np.cumsum(sizes) - sizes).tolist()
    return Vocabulary(paths, offsets, bits, int(sizes.sum()), sum(r.tokens for r in made))


def _ngrams(texts: DataFrame, vocabulary: Vocabulary, bounds: list[int]) -> DataFrame:
    """Packed bigram and trigram counts of each slice of text, by shard of the first word."""
    edges = np.array([*bounds, vocabulary.size + 1], np.uint64) << np.uint64(32)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary.begin()
        for batch in batches:
            for _, _, data, rows in slices(batch.column("text"), SLICE):
                seq, ends = sequence(*words(data, rows, VISIBLE), vocabulary.ids, vocabulary.size)
                starts = np.ones(len(seq), bool)
                starts[ends[1:] - 1] = False  # a pair does not begin at an end
                first = np.flatnonzero(starts)
                pairs = (seq[first].astype(np.uint64) << np.uint64(32)) | seq[first + 1].astype(np.uint64)
                keys, which, n = np.unique(pairs, return_inverse=True, return_counts=True)
                longer = np.flatnonzero(starts[first + 1])
                triples = (which[longer].astype(np.uint64) << np.uint64(32)) | seq[first[longer] + 2].astype(np.uint64)
                threes, m = np.unique(triples, return_counts=True)
                at = np.searchsorted(keys, edges)
                cut = np.searchsorted(threes, at.astype(np.uint64) << np.uint64(32))
                out = []
                for s in range(len(bounds)):
                    a, b, c, d = at[s], at[s + 1], cut[s], cut[s + 1]
                    if a < b:
                        local = threes[c:d] - (np.uint64(a) << np.uint64(32))
                        out.append({
                            "shard": s, "n": int(b - a), "m": int(d - c), "pairs": _pack(_steps(keys[a:b])),
                            "counts": _pack(n[a:b].astype(np.int64)), "threes": _pack(_steps(local)),
                            "more": _pack(m[c:d].astype(np.int64))})
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=packed)

    packed = pa.schema([("shard", pa.int64()), ("n", pa.int64()), ("m", pa.int64()), ("pairs", pa.binary()),
                        ("counts", pa.binary()), ("threes", pa.binary()), ("more", pa.binary())])
    return texts.mapInArrow(count, "shard long, n long, m long, pairs binary, counts binary, threes binary, "
                                   "more binary")


def _merged(packed: DataFrame, shards: int) -> DataFrame:
    """One row for each shard: its pairs and triples with all their counts, packed, and how many
    of them occur once and twice."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _grouped(batches):
            keys, n, which = _summed(
                np.concatenate([np.cumsum(_unpack(r["pairs"], r["n"], np.uint64)) for r in rows]),
                np.concatenate([_unpack(r["counts"], r["n"], np.int64) for r in rows]))
            shift, parts = 0, []
            for r in rows:  # positions in a slice's pairs become nodes
                t = np.cumsum(_unpack(r["threes"], r["m"], np.uint64))
                node = which[shift:shift + r["n"]][(t >> np.uint64(32)).astype(np.int64)]
                parts.append((node.astype(np.uint64) << np.uint64(32)) | (t & np.uint64(0xFFFFFFFF)))
                shift += r["n"]
            threes, m, _ = _summed(np.concatenate(parts), np.concatenate(
                [_unpack(r["more"], r["m"], np.int64) for r in rows]))
            del parts, which
            _, kinds = np.unique(keys >> np.uint64(32), return_counts=True)
            yield pa.RecordBatch.from_pylist([{
                "shard": shard, "n": len(keys), "m": len(threes), "most": int(kinds.max()),
                "once": int((n == 1).sum()), "twice": int((n == 2).sum()),
                "once3": int((m == 1).sum()), "twice3": int((m == 2).sum()),
                "pairs": _pack(_steps(keys)), "counts": _pack(n), "threes": _pack(_steps(threes)), "more": _pack(m)}])

    return _dealt(packed, shards).mapInArrow(
        merge, "shard long, n long, m long, most long, once long, twice long, once3 long, twice3 long, "
               "pairs binary, counts binary, threes binary, more binary")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One shard at a time."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]
            pa.default_memory_pool().release_unused()


def _second(merged: DataFrame, vocabulary: Vocabulary, bounds: list[int], off: float, off3: float,
            staging: Staging) -> DataFrame:
    """Writes the second level."""
    folder = staging.path("second")
    ends = [*bounds[1:], vocabulary.size + 1]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary.begin()
        for r in _rows(batches):
            low, room = bounds[r["shard"]], ends[r["shard"]] - bounds[r["shard"]]
            keys, n = np.cumsum(_unpack(r["pairs"], r["n"], np.uint64)), _unpack(r["counts"], r["n"], np.int64)
            context = (keys >> np.uint64(32)).astype(np.int64) - low
            word = (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
            total, kinds = np.bincount(context, n, room), np.bincount(context, minlength=room)
            share = np.where(total > 0, off * kinds / np.maximum(total, 1), 1.0)
            lower = vocabulary.unigram(vocabulary.counts(word))
            prob = (n - off) / total[context] + share[context] * lower
            node = (np.cumsum(_unpack(r["threes"], r["m"], np.uint64)) >> np.uint64(32)).astype(np.int64)
            m = _unpack(r["more"], r["m"], np.int64)
            total3, kinds3 = np.bincount(node, m, len(keys)), np.bincount(node, minlength=len(keys))
            share3 = np.where(total3 > 0, off3 * kinds3 / np.maximum(total3, 1), 1.0)
            path = f"{folder}/{r['shard']}-{np.random.default_rng().integers(1 << 62):x}"
            universe = vocabulary.size + 1
            begins = np.searchsorted(context, np.arange(room + 1)).astype(np.uint64)
            save(path, {
                "start": EliasFano.encode(begins, len(keys) + 1), "prob": _code(prob), "back": _code(share),
                "back2": _code(share3),
                "key": EliasFano.encode((context * universe + word).astype(np.uint64), room * universe)})
            yield pa.RecordBatch.from_pylist([{"shard": r["shard"], "path": path}])

    return merged.drop("most").mapInArrow(write, "shard long, path string")


def _third(merged: DataFrame, levels: Levels, room: int, off: float, staging: Staging) -> DataFrame:
    """Writes the third level, by places among the words after the middle word."""
    folder = staging.path("third")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels.vocabulary.begin()
        for r in _rows(batches):
            keys = np.cumsum(_unpack(r["pairs"], r["n"], np.uint64))
            threes = np.cumsum(_unpack(r["threes"], r["m"], np.uint64))
            m = _unpack(r["more"], r["m"], np.int64)
            node = (threes >> np.uint64(32)).astype(np.int64)
            middle = (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)[node]
            _, place, code = levels.pairs(middle, (threes & np.uint64(0xFFFFFFFF)).astype(np.int64))
            total, kinds = np.bincount(node, m, len(keys)), np.bincount(node, minlength=len(keys))
            prob = (m - off) / total[node] + off * kinds[node] / total[node] * 10.0 ** (-code / STEP)
            path = f"{folder}/{r['shard']}-{np.random.default_rng().integers(1 << 62):x}"
            value = (node * room + place).astype(np.uint64)
            order = np.argsort(value, kind="stable")
            save(path, {"key": EliasFano.encode(value[order], max(1, len(keys)) * room), "prob": _code(prob[order]),
                        "room": np.array([room], np.int64)})
            yield pa.RecordBatch.from_pylist([{"shard": r["shard"], "path": path}])

    return merged.select("shard", "n", "m", "pairs", "threes", "more").mapInArrow(write, "shard long, path string")


def learn(docs: DataFrame, staging: Staging, shard_bytes: int = 6 << 20) -> Levels:
    """The model of all texts of ``docs``; a null text is an empty one (an end and nothing else)."""
    texts = docs.select(full_text().alias("text"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(1, -(-size // shard_bytes))
    vocabulary = _vocabulary(texts, (shards - 1).bit_length(), staging)
    if vocabulary.size >= 1 << 32:
        raise ValueError(f"{vocabulary.size} distinct words; ids have 32 bits")
    bounds = [s * (vocabulary.size + 1) // shards for s in range(shards)]
    levels = Levels(vocabulary, bounds, [None] * shards, [None] * shards)
    with Staging(docs.sparkSession) as scratch:
        merged = scratch.put(_merged(_ngrams(texts, vocabulary, bounds), shards), "merged")
        names = ("once", "twice", "once3", "twice3")
        found = merged.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names],
                           F.coalesce(F.max("most"), F.lit(1)).alias("most")).first()
        off, off3 = _discount(found.once, found.twice), _discount(found.once3, found.twice3)
        for r in _second(merged, vocabulary, bounds, off, off3, staging).collect():  # one small row per shard
            levels.second[r.shard] = r.path
        for r in _third(merged, levels, found.most, off3, staging).collect():
            levels.third[r.shard] = r.path
    return levels


def held_out(doc_id: Column) -> Column:
    """A fifth of the ids; a null id is learned from."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 1, F.lit(False))


def score(docs: DataFrame, levels: Levels) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and
    ``score`` of every row.

    A null or empty text is its end alone. Repeated rows are repeated; an empty table gives no
    rows. With nothing learned every word is unknown and both scores are those of unigrams.
    """
    vocabulary = levels.vocabulary

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary.begin()
        for batch in batches:
            rows = batch.num_rows
            tokens, known = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            base, model = np.zeros(rows), np.zeros(rows)
            for lo, hi, data, bounds in slices(batch.column("text")):
                seq, cuts = sequence(*words(data, bounds, VISIBLE), vocabulary.ids, vocabulary.size)
                tokens[lo:hi] = np.diff(cuts) - 1
                counts = vocabulary.counts(seq)
                plain = np.log10(vocabulary.unigram(counts))
                counts[cuts[:-1]], plain[cuts[:-1]] = 0, 0.0
                known[lo:hi] = np.add.reduceat((counts > 0).astype(np.int64), cuts[:-1])
                base[lo:hi] = np.add.reduceat(plain, cuts[:-1])
                model[lo:hi] = np.add.reduceat(levels.score(seq, cuts, plain), cuts[:-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(tokens), pa.array(known),
                 pa.array(np.full(rows, vocabulary.tokens)), pa.array(base), pa.array(model)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), full_text().alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(work, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                 "base_score double, score double")
