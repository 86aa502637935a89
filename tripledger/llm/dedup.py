"""Exact deduplication with radix tries that own the texts.

Rows go to partitions by length and content hash of their bytes. A task inserts the full byte
strings into a compressed radix trie; the terminal node of a string holds the id that stays and
how many rows share it. Equality is therefore decided on the bytes, the hash only deals them out.
Every input task first collapses its own rows by the same trie, so a text that a third of all
rows share leaves each task once. Bytes held by a trie are bounded: past the bound the largest
subtree goes to a file and is finished later by itself.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger.llm.common import full_text, row_key, without
from tripledger.staging import Staging

BUDGET = 64 << 20
FLUSH = 4 << 20
ROWS = 256
NODE_COST = 400


class _Node:
    __slots__ = ("edge", "kids", "value", "file")

    def __init__(self, edge: bytes, value=None):
        self.edge, self.kids, self.value, self.file = edge, {}, value, None


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving: comparisons run at memory speed."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


class Trie:
    """Byte strings with a merged value each, in bounded memory.

    ``merge(old, new)`` must not depend on the order of insertion.
    """

    def __init__(self, merge, budget: int = BUDGET, folder: str | None = None):
        self.merge, self.budget, self.folder = merge, budget, folder
        self.root, self.used, self.spilled = _Node(b""), 0, 0

    def insert(self, key: bytes, value) -> None:
        node, at = self.root, 0
        while True:
            if node.file is not None:
                pickle.dump((key[at:], value), node.file)
                return
            if at == len(key):
                node.value = value if node.value is None else self.merge(node.value, value)
                return
            kid = node.kids.get(key[at])
            if kid is None:
                node.kids[key[at]] = _Node(key[at:], value)
                self.used += len(key) - at + NODE_COST
                break
            rest = key[at:at + len(kid.edge)]
            if rest != kid.edge:
                cut = _common(rest, kid.edge)
                upper = _Node(kid.edge[:cut])
                kid.edge = kid.edge[cut:]
                upper.kids[kid.edge[0]] = kid
                node.kids[upper.edge[0]] = upper
                self.used += NODE_COST
                kid = upper
            node, at = kid, at + len(kid.edge)
        if self.used > self.budget:
            self._spill()

    @staticmethod
    def _walk(node: _Node, prefix: bytes):
        stack = [(node, prefix)]
        while stack:
            node, prefix = stack.pop()
            if node.value is not None:
                yield prefix, node.value
            for kid in node.kids.values():
                if kid.file is None:
                    stack.append((kid, prefix + kid.edge))

    def _size(self, node: _Node) -> int:
        total, stack = 0, [node]
        while stack:
            x = stack.pop()
            total += len(x.edge) + NODE_COST
            stack += x.kids.values()
        return total

    def _spill(self) -> None:
        """Write the largest subtree below the first fork to a file, and route to it from now."""
        top = self.root
        while len(top.kids) == 1 and top.value is None:
            only = next(iter(top.kids.values()))
            if only.file is not None or not only.kids:
                break
            top = only
        open_kids = [k for k in top.kids.values() if k.file is None]
        if not open_kids:
            return
        kid = max(open_kids, key=self._size)
        self.used -= self._size(kid)
        kid.file = tempfile.TemporaryFile(dir=self.folder)
        for rest, value in self._walk_all(kid):
            pickle.dump((rest, value), kid.file)
        kid.kids, kid.value = {}, None
        self.spilled += 1

    def _walk_all(self, kid: _Node):
        """Strings below ``kid``, without its edge; files below it are read and closed."""
        stack = [(kid, b"")]
        while stack:
            node, prefix = stack.pop()
            if node is not kid and node.file is not None:
                for rest, value in _records(node.file):
                    yield prefix + rest, value
                continue
            if node.value is not None:
                yield prefix, node.value
            for k in node.kids.values():
                stack.append((k, prefix + k.edge))

    def items(self) -> Iterator[tuple[bytes, object]]:
        """All strings and values; spilled subtrees follow, one at a time, each in a new trie."""
        yield from self._walk(self.root, b"")
        stack = [(self.root, b"")]
        while stack:
            node, prefix = stack.pop()
            if node.file is not None:
                below = Trie(self.merge, self.budget, self.folder)
                for rest, value in _records(node.file):
                    below.insert(rest, value)
                for rest, value in below.items():
                    yield prefix + rest, value
                continue
            for kid in node.kids.values():
                stack.append((kid, prefix + kid.edge))


def _records(file):
    file.flush()
    size = os.fstat(file.fileno()).st_size
    file.seek(0)
    while file.tell() < size:
        yield pickle.load(file)
    file.close()


def _merge(largest: bool):
    """Values are (hash, id or None, rows, rows of that id); the better id wins, a null id only
    where there is no other."""
    def rank(v):
        return (v[1] is None, 0 if v[1] is None else -v[1] if largest else v[1])

    def merge(a, b):
        first = a if rank(a) <= rank(b) else b
        return first[0], first[1], a[2] + b[2], a[3] + b[3] if a[1] == b[1] else first[3]
    return merge


NAMES = ["size", "hash", "body", "id", "rows", "same"]
KINDS = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
SCHEMA = "size long, hash long, body binary, id long, rows long, same long"


def _collapse(largest: bool, last: bool, budget: int):
    """Merge rows by their bytes. The first pass hands a full trie on and starts another; the
    last one keeps all strings, spilling, and gives a digest in place of the bytes."""
    merge = _merge(largest)

    def out(trie: Trie) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for body, (hashed, *value) in trie.items():
            rows.append((len(body), hashed, hashlib.sha256(body).digest() if last else body, *value))
            held += 100 + (0 if last else len(body))
            if held > FLUSH:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, k) for x, k in zip(zip(*rows), KINDS)], names=NAMES)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(zip(*rows), KINDS)], names=NAMES)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fresh():
            return Trie(merge, budget if last else 1 << 62)
        trie = fresh()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                for _, hashed, body, *value in zip(*(part.column(n).to_pylist() for n in NAMES)):
                    trie.insert(body, (hashed, *value))
                    if not last and trie.used > budget:
                        yield from out(trie)
                        trie = fresh()
        yield from out(trie)
    return work


def owners(docs: DataFrame, largest: bool = False, budget: int = BUDGET) -> DataFrame:
    """One row per distinct text: ``sha`` (SHA-256 of its bytes), ``size``, ``keep_id``, ``rows``
    (rows with this text) and ``same`` (those of them that have the id that stays).

    The smallest id stays, or the largest. Null text counts as empty; a null id stays only where
    its text has no other.
    """
    one = F.lit(1).cast("long")
    rows = docs.select(
        F.octet_length(full_text()).cast("long").alias("size"),
        F.xxhash64(full_text()).alias("hash"), F.encode(full_text(), "UTF-8").alias("body"),
        F.col("doc_id").cast("long").alias("id"), one.alias("rows"), one.alias("same"))
    local = rows.mapInArrow(_collapse(largest, False, budget), SCHEMA)
    dealt = local.repartition("size", "hash")
    return dealt.mapInArrow(_collapse(largest, True, budget), SCHEMA).select(
        F.lower(F.hex("body")).alias("sha"), "size", F.col("id").alias("keep_id"), "rows", "same")


def _digest():
    return F.sha2(F.encode(full_text(), "UTF-8"), 256)


def marked(docs: DataFrame, staging: Staging, largest: bool = False) -> DataFrame:
    """Every row's ``doc_id``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Exactly one row of each text is kept: of rows that repeat both the id and the text, which
    nothing tells apart here, one is. Null text is empty. An empty table gives no rows.
    """
    own = owners(docs, largest).select(F.col("sha").alias("text_sha256"), "keep_id",
                                       F.col("rows").alias("group_size"), "same")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _digest().alias("text_sha256"))
    found = staging.put(rows.join(own, "text_sha256").select(
        "doc_id", "keep_id", "group_size", "text_sha256",
        F.when(F.col("doc_id").eqNullSafe(F.col("keep_id")),
               F.when(F.col("same") > 1, "tied").otherwise("kept")).otherwise("gone").alias("fate")), "fates")
    # Rows that tie are counted and dealt out again, so that a window over a hot id is not needed.
    tied = found.where("fate = 'tied'").groupBy(*found.columns).count().select(
        *found.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("count"))).alias("k"))
    fates = found.where("fate <> 'tied'").withColumn("kept", F.col("fate") == "kept").unionByName(
        tied.withColumn("kept", F.col("k") == 1).drop("k"))
    return fates.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def drop_copies(docs: DataFrame, staging: Staging, largest: bool = False) -> DataFrame:
    """The one row of each text that stays, with all its columns. Null text is empty. Of rows that
    repeat both the id and the text, any one stays. An empty table gives no rows.

    Only the rows of texts that several rows share are asked for, by a digest; a text that rows
    with the id that stays share is reduced to one row, in every task before the shuffle.
    """
    own = staging.put(owners(docs, largest).select("sha", "keep_id", "same", "rows"), "owners")
    shared = own.where("rows > 1")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), _digest().alias("sha"), row_key().alias("key"))
    found = rows.join(shared, "sha")
    kept = F.col("id").eqNullSafe(F.col("keep_id"))
    gone = staging.put(found.where(~kept | (F.col("same") > 1)).select("id", "key", (kept).alias("tie")).distinct(), "copies")
    ties = gone.where("tie").select("id", "key")
    stay = without(docs, gone, staging)
    if ties.isEmpty():
        return stay
    # Which columns the row that stays has does not matter, but they must be one row's.
    again = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("_id"), row_key().alias("_key"))
    again = again.join(ties, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_key") == F.col("key")), "left_semi")
    once = again.groupBy("_id", "_key").agg(F.first("row").alias("row"))
    return stay.unionByName(once.select("row.*"))
