"""Elias-Fano sequences in NumPy, and files of arrays that are mapped into memory."""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from functools import lru_cache

import numpy as np
from pyarrow import fs

BLOCK = 8  # words of a directory entry
ONE = np.uint64(1)


def _words(bits: int) -> int:
    return bits // 64 + 2


def _repeat(byte: int) -> np.uint64:
    return np.uint64(byte * 0x0101010101010101)


#: Position of the r-th set bit of a byte b, at 8 b + r.
IN_BYTE = np.array([([i for i in range(8) if b >> i & 1] + [0] * 8)[r] for b in range(256) for r in range(8)], np.int64)


def _directory(words: np.ndarray) -> np.ndarray:
    """Set bits before each block of words."""
    padded = np.concatenate([words, np.zeros(-len(words) % BLOCK, np.uint64)])
    counts = np.bitwise_count(padded).reshape(-1, BLOCK).sum(axis=1, dtype=np.int64)
    return np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)


def _select(words: np.ndarray, before: np.ndarray, k: np.ndarray, flip: bool) -> np.ndarray:
    """Position of the k-th set (or, flipped, clear) bit, from 0."""
    block = np.searchsorted(before, k, side="right") - 1
    rest, at = k - before[block], block * BLOCK

    def word(i):
        return ~words[i] if flip else words[i]
    x = word(at)
    have = np.bitwise_count(x).astype(np.int64)
    active = np.flatnonzero(rest >= have)
    while len(active):
        rest[active] -= have[active]
        at[active] += 1
        x[active] = word(at[active])
        have[active] = np.bitwise_count(x[active])
        active = active[rest[active] >= have[active]]
    # Set bits of each byte, then of all bytes up to each, in the bytes of one number; the byte that
    # holds the bit comes after those that hold too few.
    r = rest.astype(np.uint64)
    bytes_ = x - ((x >> ONE) & _repeat(0x55))
    bytes_ = (bytes_ & _repeat(0x33)) + ((bytes_ >> np.uint64(2)) & _repeat(0x33))
    upto = ((bytes_ + (bytes_ >> np.uint64(4))) & _repeat(0x0F)) * _repeat(1)
    shift = np.bitwise_count((((r * _repeat(1)) | _repeat(0x80)) - upto) & _repeat(0x80)).astype(np.uint64) << np.uint64(3)
    r -= ((upto << np.uint64(8)) >> shift) & np.uint64(255)
    inside = IN_BYTE[(((x >> shift) & np.uint64(255)) << np.uint64(3)) | r]
    return at * 64 + shift.astype(np.int64) + inside


class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits in unary with directories."""

    PARTS = ("low", "high", "ones", "zeros")

    def __init__(self, n: int, width: int, top: int, arrays: dict[str, np.ndarray]):
        self.n, self.width, self.top = n, width, top
        self.low, self.high, self.ones, self.zeros = (arrays[p] for p in self.PARTS)
        self.mask = np.uint64((1 << width) - 1)

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> "EliasFano":
        n = len(values)
        width = max(0, (max(1, universe) // max(1, n)).bit_length() - 1)
        values = values.astype(np.uint64)
        top = max(0, universe - 1) >> width
        places = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        bits = np.zeros(_words(n + top + 1) * 64, bool)
        bits[places] = True
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        low = np.zeros(_words(n * width), np.uint64)
        if width and n:
            part = values & np.uint64((1 << width) - 1)
            at = np.arange(n, dtype=np.int64) * width
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            np.bitwise_or.at(low, word, part << shift)
            over = (at & 63) + width > 64
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        return cls(n, width, top, {"low": low, "high": high, "ones": _directory(high),
                                   "zeros": _directory(~high)})

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.uint64)
        at = i * self.width
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        return ((self.low[word] >> shift)
                | ((self.low[word + 1] << ONE) << (np.uint64(63) - shift))) & self.mask

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values at positions ``i``."""
        if not len(i):
            return np.empty(0, np.uint64)
        high = _select(self.high, self.ones, i, False) - i
        return (high.astype(np.uint64) << np.uint64(self.width)) | self._low(i)

    def successor(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each value, the position of the first element not below it, and whether it is equal."""
        if not len(values) or not self.n:
            return np.full(len(values), self.n), np.zeros(len(values), bool)
        high = (values >> np.uint64(self.width)).astype(np.int64)
        beyond = high > self.top
        high = np.minimum(high, self.top)
        first = np.zeros(len(values), np.int64)
        inner = np.flatnonzero(high > 0)
        first[inner] = _select(self.high, self.zeros, high[inner] - 1, True) + 1
        low = first - high  # a zero closes each group of equal high bits
        rest = ~self.high[first >> 6] >> (first & 63).astype(np.uint64)
        near = rest != 0
        end = first + np.bitwise_count((rest & (~rest + ONE)) - ONE).astype(np.int64)
        far = np.flatnonzero(~near)
        end[far] = _select(self.high, self.zeros, high[far], True)
        stop = end - high
        want, hi = values & self.mask, stop.copy()
        active = np.flatnonzero(low < hi)
        while len(active):
            mid = (low[active] + hi[active]) >> 1
            less = self._low(mid) < want[active]
            low[active[less]] = mid[less] + 1
            hi[active[~less]] = mid[~less]
            active = active[low[active] < hi[active]]
        equal = (low < stop) & ~beyond
        at = np.flatnonzero(equal)
        equal[at] = self._low(low[at]) == want[at]
        low[beyond] = self.n
        return low, equal

    def locate(self, values: np.ndarray) -> np.ndarray:
        """Positions of ``values``, -1 where they are absent."""
        at, equal = self.successor(values)
        return np.where(equal, at, -1)


def save(path: str, parts: dict[str, np.ndarray | EliasFano]) -> None:
    """Write arrays and sequences as one file of any file system that PyArrow knows."""
    arrays, sequences = {}, {}
    for name, part in parts.items():
        if isinstance(part, EliasFano):
            sequences[name] = [part.n, part.width, part.top]
            arrays |= {f"{name}.{p}": getattr(part, p) for p in EliasFano.PARTS}
        else:
            arrays[name] = part
    index, at = {}, 0
    for name, a in arrays.items():
        index[name] = [a.dtype.str, len(a), at]
        at += -(-a.nbytes // 8) * 8
    head = json.dumps({"arrays": index, "sequences": sequences}).encode()
    head += b" " * (-len(head) % 8)
    system, plain = where(path)
    system.create_dir(plain.rpartition("/")[0], recursive=True)
    with system.open_output_stream(plain, compression=None) as out:
        out.write(len(head).to_bytes(8, "little") + head)
        for a in arrays.values():
            out.write(np.ascontiguousarray(a).tobytes())
            out.write(b"\0" * (-a.nbytes % 8))


def where(path: str):
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path[5:]
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


_OWNER: list[str | None] = [None]


def mapped_for(owner: str | None) -> None:
    """Let go of the files of other owners. A worker process outlives its task, and what it has
    mapped counts as its memory."""
    if _OWNER[0] != owner:
        load.cache_clear()
        _OWNER[0] = owner


@lru_cache(maxsize=4096)
def load(path: str) -> dict[str, np.ndarray | EliasFano]:
    """Map a file. One that is not on a mounted file system is fetched to scratch space first."""
    system, plain = where(path)
    if not isinstance(system, fs.LocalFileSystem):
        local = os.path.join(tempfile.gettempdir(), f"level-{uuid.uuid4().hex}")
        fs.copy_files(plain, local, source_filesystem=system, destination_filesystem=fs.LocalFileSystem())
        mapped = np.memmap(local, np.uint8, "r")
        os.unlink(local)  # the mapping keeps the bytes until it goes
    else:
        mapped = np.memmap(plain, np.uint8, "r")
    mapped = np.asarray(mapped)
    size = int(mapped[:8].view(np.uint64)[0])
    head, base = json.loads(bytes(mapped[8:8 + size])), 8 + size
    arrays = {}
    for name, (kind, n, at) in head["arrays"].items():
        width = np.dtype(kind).itemsize
        arrays[name] = mapped[base + at:base + at + n * width].view(kind)
    for name, (n, width, top) in head["sequences"].items():
        parts = {p: arrays.pop(f"{name}.{p}") for p in EliasFano.PARTS}
        arrays[name] = EliasFano(n, width, top, parts)
    return arrays
