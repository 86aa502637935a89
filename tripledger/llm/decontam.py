"""Benchmark decontamination: passages of documents within a small edit distance of an item.

Texts are sequences of words (letters and digits, A-Z in lower case). A document is contaminated
by an item of n words if some passage is within k = floor(``share`` * n) word edits of it.

Over each document slides a window of n + k words for every length n of the items. Windows with
too few word pairs that any item has are passed over: by the q-gram lemma a passage within k edits
keeps n - 1 - 2k of the item's pairs, so this loses nothing. The others are embedded by CGK
random walks: step j writes the current word and moves on or not by a random bit of (j, word), so
that few edits become few differing places. Bit-sampling LSH on the embeddings, ``walks`` times
``tables`` with ``picks`` places each, finds the items that collide; a candidate counts only if
the exact edit distance of the item to a prefix of the window is at most k.

Items go to the tasks in blocks of at most ``block_words`` words, each a pass over the documents.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger.llm.common import full_text, without
from tripledger.llm.tokens import ALNUM, mixed, slices, words
from tripledger.staging import Staging

SHARE = 0.2
PAIR_BITS = 22
WINDOWS = 1 << 14


def _pairs(tokens: np.ndarray) -> np.ndarray:
    return ((tokens[:-1] * np.uint64(0x9E3779B97F4A7C15) + tokens[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
            >> np.uint64(64 - PAIR_BITS)).astype(np.int64)


def embed(rows: np.ndarray, sizes: np.ndarray, steps: int, walk: int) -> np.ndarray:
    """CGK embedding of each row's first ``sizes`` words; past the end it writes zeros. A word's
    random bits for 64 steps are those of one hash."""
    out = np.zeros((steps, len(rows)), np.uint64)
    width = rows.shape[1] + 1
    padded = np.concatenate([rows, np.zeros((len(rows), 1), np.uint64)], axis=1).ravel()
    first = np.arange(len(rows)) * width
    at, end = first.copy(), first + sizes
    for j in range(steps):
        if j % 64 == 0:
            bits = mixed(padded + np.uint64((walk << 32) + j + 1))
        out[j] = padded[at]
        at += (bits[at] >> np.uint64(j % 64) & np.uint64(1)).astype(np.int64)
        np.minimum(at, end, out=at)
    return out


def signatures(rows: np.ndarray, sizes: np.ndarray, length: int, walks: int, tables: int, picks: int
               ) -> np.ndarray:
    """``walks`` * ``tables`` signatures a row: hashes of the embedding at sampled places. A walk
    of 2 * ``length`` steps has passed most of the words, so later places tell little."""
    found = []
    for walk in range(walks):
        embedding = embed(rows, sizes, 2 * length, walk)
        draw = np.random.default_rng((length, walk))
        for table in range(tables):
            key = np.full(len(rows), walk * tables + table + 1, np.uint64)
            for place in draw.integers(0, 2 * length, picks):
                key = key * np.uint64(0x9E3779B97F4A7C15) + embedding[place]
                key ^= key >> np.uint64(29)
            found.append(mixed(key))
    return np.stack(found, axis=1)


def prefix_distance(item: np.ndarray, window: np.ndarray, most: int) -> int:
    """Least edit distance of ``item`` to a prefix of ``window``; anything above ``most`` stands
    for too far."""
    row = np.arange(len(item) + 1)  # over the item, for the empty prefix
    best, steps = row[-1], np.arange(len(item) + 1)
    for i, word in enumerate(window):
        free = np.minimum(row[1:] + 1, row[:-1] + (item != word))
        row = np.minimum.accumulate(np.concatenate([[i + 1], free]) - steps) + steps
        best = min(best, row[-1])
        if row.min() > most:
            break
    return int(best)


class Index:
    """The items of one block, for one task: signatures by length, and a table of word pairs with
    a bit for each length (modulo 64) of the items that have the pair."""

    def __init__(self, items: list[tuple[int, np.ndarray]], share: float, walks: int, tables: int, picks: int):
        self.share, self.how, self.items = share, (walks, tables, picks), items
        self.pairs = np.zeros(1 << PAIR_BITS, np.uint64)
        self.by_length: dict[int, dict[int, list[int]]] = {}
        lengths = defaultdict(list)
        for k, (_, tokens) in enumerate(items):
            self.pairs[_pairs(tokens)] |= np.uint64(1 << len(tokens) % 64)
            lengths[len(tokens)].append(k)
        for n, own in lengths.items():
            rows = np.stack([items[k][1] for k in own])
            signs = signatures(rows, np.full(len(own), n), n, *self.how)
            table = defaultdict(list)
            for k, row in zip(own, signs.tolist()):
                for sign in row:
                    table[sign].append(k)
            self.by_length[n] = dict(table)

    def hits(self, tokens: np.ndarray, cuts: np.ndarray) -> set[tuple[int, int]]:
        """(row, item) by position, for the rows that ``cuts`` parts the words of a slice into."""
        found: set[tuple[int, int]] = set()
        if len(tokens) < 2:
            return found
        masks = np.zeros(len(tokens), np.uint64)
        masks[:-1] = self.pairs[_pairs(tokens)]
        inner = cuts[1:-1]
        masks[inner[(inner > 0)] - 1] = 0  # a pair does not reach into the next row
        every = np.arange(len(tokens))
        row_of = np.searchsorted(cuts, every, side="right") - 1
        last = cuts[row_of + 1]
        sums = np.concatenate([[0], np.cumsum(masks != 0)])
        for n, table in self.by_length.items():
            k = int(self.share * n)
            stops = np.minimum(every + n + k, last)
            starts = np.flatnonzero(sums[stops - 1] - sums[:-1] >= n - 1 - 2 * k)
            if not len(starts):
                continue
            own = np.concatenate([[0], np.cumsum((masks >> np.uint64(n % 64)) & np.uint64(1))]).astype(np.int64)
            shared = own[stops[starts] - 1] - own[starts]
            good = (shared >= n - 1 - 2 * k) & (stops[starts] - starts >= n - k)
            starts, shared = starts[good], shared[good]
            for at in range(0, len(starts), WINDOWS):
                part = starts[at:at + WINDOWS]
                self._search(tokens, part, stops[part] - part, row_of[part], shared[at:at + WINDOWS], n, k,
                             table, found)
        return found

    def _search(self, tokens, starts, sizes, owners, shared, n, k, table, found) -> None:
        places = starts[:, None] + np.arange(n + k)
        rows = np.where(np.arange(n + k) < sizes[:, None], tokens[np.minimum(places, len(tokens) - 1)], np.uint64(0))
        weights = mixed(np.arange(1, n + k + 1, dtype=np.uint64)) | np.uint64(1)
        # Passages that repeat, in a document or over many, are looked at once.
        _, first, which = np.unique((rows * weights).sum(axis=1), return_index=True, return_inverse=True)
        holders = np.split(owners[np.argsort(which, kind="stable")], np.cumsum(np.bincount(which))[:-1])
        rows, sizes, shared = rows[first], sizes[first], shared[first]
        candidates = defaultdict(set)
        for w, signs in enumerate(signatures(rows, sizes, n, *self.how).tolist()):
            for sign in signs:
                if sign in table:
                    for item in table[sign]:
                        candidates[item].add(w)
        for item, ws in candidates.items():
            for w in sorted(ws, key=lambda w: -shared[w]):
                own = {(int(row), item) for row in holders[w]} - found
                if own and prefix_distance(self.items[item][1], rows[w, :sizes[w]], k) <= k:
                    found |= own


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("item_id")
        for lo, hi, data, bounds in slices(batch.column("text")):
            tokens, cuts = words(data, bounds, ALNUM)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo), pa.array([tokens[a:b].view(np.int64) for a, b in zip(cuts, cuts[1:])],
                                                  pa.list_(pa.int64()))], names=["item_id", "tokens"])


def contaminated(docs: DataFrame, items: DataFrame, staging: Staging, share: float = SHARE, walks: int = 6,
                 tables: int = 8, picks: int = 3, block_words: int = 1 << 20) -> DataFrame:
    """``doc_id``, ``text_key`` and ``item_id``, once for each document and item it holds.

    Null text is empty; texts and items of fewer than two words match nothing. An item with a null
    id is reported with a null id. Repeated rows give the same pairs once. Every document is
    searched over its whole text. Recall against brute force is measured in the tests.
    """
    listed = staging.put(items.select(F.col("item_id").cast("long").alias("item_id"), F.lower(full_text()).alias("text"))
                         .mapInArrow(_item_words, "item_id long, tokens array<long>")
                         .where("size(tokens) > 1").distinct(), "items")
    total = listed.agg(F.coalesce(F.sum(F.size("tokens")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // (block_words // 2)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(full_text()).alias("text"),
                       F.xxhash64(full_text()).alias("text_key"))
    schema = "doc_id long, text_key long, item_id long"
    found = None
    for block in range(blocks):
        part = listed.where(F.pmod(F.xxhash64("tokens"), F.lit(blocks)) == block).collect()
        block_items = [(r.item_id, np.array(r.tokens, np.int64).view(np.uint64)) for r in part]
        hits = rows.mapInArrow(_searcher(block_items, share, walks, tables, picks), schema)
        found = hits if found is None else found.unionByName(hits)
    return found.distinct()


def _searcher(items, share: float, walks: int, tables: int, picks: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(items, share, walks, tables, picks)
        for batch in batches:
            rows, which = [], []
            for lo, hi, data, bounds in slices(batch.column("text")):
                tokens, cuts = words(data, bounds, ALNUM)
                for row, k in index.hits(tokens, cuts):
                    rows.append(lo + row)
                    which.append(items[k][0])
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(at), batch.column("text_key").take(at), pa.array(which, pa.int64())],
                names=["doc_id", "text_key", "item_id"])
    return search


def drop_contaminated(docs: DataFrame, items: DataFrame, staging: Staging, **how) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns. Null and empty texts hold none;
    repeated rows go or stay together; an empty table gives no rows, and without items all stay."""
    gone = contaminated(docs, items, staging, **how)
    return without(docs, gone.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key")), staging)
