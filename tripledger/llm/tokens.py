"""Words of many texts at once, as 64-bit hashes, with NumPy."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE = 4 << 20
CHUNK = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Bytes of a word: all but ASCII white space, or letters and digits with all of UTF-8's others.
VISIBLE = np.ones(256, bool)
VISIBLE[[32, 9, 10, 11, 12, 13]] = False
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
CODES = np.random.default_rng(2).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(size: int, base: int) -> np.ndarray:
    steps = np.full(size, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def _hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial in a random code per byte, of the bytes of each word, and its length."""
    found = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        at = int(starts[lo])
        hi = max(lo + 1, int(np.searchsorted(ends, at + CHUNK, side="right")))
        size = int(ends[hi - 1]) - at
        room = 1 << max(20, (size - 1).bit_length())
        sums = np.empty(size + 1, np.uint64)
        sums[0] = 0
        np.cumsum(CODES[data[at:at + size]] * _powers(room, BASE)[:size], out=sums[1:])
        s, e = starts[lo:hi] - at, ends[lo:hi] - at
        found[lo:hi] = (sums[e] - sums[s]) * _powers(room, INVERSE)[s]
        lo = hi
    return mixed(found + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def slices(texts: pa.Array, size: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows in order, a few MB of text (or ``size`` bytes) at a time: first row, last row (exclusive), bytes with A-Z
    in lower case, and the rows' bounds in them. One longer text is a slice by itself."""
    size, texts = size or SLICE, texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        hi = min(hi, len(texts))
        yield lo, hi, LOWER[data[offsets[lo]:offsets[hi]]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def words(data: np.ndarray, bounds: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a slice, and how many of them come before each row and the end."""
    inside = letters[data]
    before = np.empty(len(inside) + 1, bool)
    before[0], before[1:] = False, inside
    before[bounds] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.empty(len(inside) + 1, bool)
    after[:-1], after[-1] = inside, False
    after[bounds] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return _hash(data, starts, ends), np.searchsorted(starts, bounds)
