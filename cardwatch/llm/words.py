"""Vectorised word access to Arrow string columns.

A *word* is a maximal run of bytes other than 0x20 and 0x09-0x0D, which on
UTF-8 text equals ``[^\\x20\\x09-\\x0D]+``.  All functions work on the joined
byte buffer of many texts at once, so no Python code runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is handled alone, whole.
CHUNK_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_rng = np.random.default_rng(20240607)
_TABLE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_pow = np.ones(1, np.uint64)
_inv = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i <= n."""
    global _pow, _inv
    if len(_pow) <= n:
        m = 1 << max(10, int(n).bit_length())
        inverse = pow(_BASE, -1, 1 << 64)
        one = np.ones(1, np.uint64)
        _pow = np.concatenate([one, np.cumprod(np.full(m, _BASE, np.uint64))])
        _inv = np.concatenate([one, np.cumprod(np.full(m, inverse, np.uint64))])
    return _pow, _inv


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective), so that every bit depends on every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Stretches:
    """Hashes of stretches of a sequence of 64-bit items, each from two prefix sums, however long it is."""

    def __init__(self, items: np.ndarray):
        self.power, self.inverse = _powers(len(items))
        self.total = np.zeros(len(items) + 1, np.uint64)
        np.cumsum(items * self.power[:len(items)], out=self.total[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def byte_items(data: np.ndarray) -> np.ndarray:
    """A 64-bit item for each byte."""
    return _TABLE[data]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def chunks(data: np.ndarray, off: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``size`` bytes: (first, past last, bytes, offsets)."""
    n, i = len(off) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, "right")) - 1)
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


class Words:
    """Words of a run of texts: byte ``start`` / ``end`` and the index range
    ``first[i]:first[i + 1]`` of text i's words."""

    def __init__(self, data: np.ndarray, off: np.ndarray, lower: bool = True):
        self.data = LOWER[data] if lower else data
        word = ~SPACE[data]
        begin, cut = word.copy(), np.zeros(len(data) + 1, bool)
        cut[off] = True
        begin[1:] &= ~word[:-1] | cut[1:-1]
        over = word.copy()
        over[:-1] &= ~word[1:] | cut[1:-1]
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(over) + 1
        self.first = np.searchsorted(self.start, off)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word."""
        return Stretches(byte_items(self.data)).hashes(self.start, self.end)

    def text(self, which: np.ndarray) -> pa.Array:
        """The chosen words as strings."""
        size = self.end[which] - self.start[which]
        at = np.zeros(len(which) + 1, np.int64)
        np.cumsum(size, out=at[1:])
        take = np.arange(at[-1]) + np.repeat(self.start[which] - at[:-1], size)
        return pa.LargeStringArray.from_buffers(len(which), pa.py_buffer(at), pa.py_buffer(self.data[take]))


def shingles(word_hash: np.ndarray, k: int = 5) -> np.ndarray:
    """Hash of each k consecutive words; of all words as one if fewer; none without words."""
    n = len(word_hash)
    if n == 0:
        return word_hash
    w = min(k, n)
    out = np.zeros(n - w + 1, np.uint64)
    for i in range(w):
        out = (out + word_hash[i:n - w + 1 + i]) * np.uint64(_BASE)
    return mix(out + np.uint64(w))


def signed(x: np.ndarray) -> np.ndarray:
    """uint64 hashes as Spark's signed longs."""
    return np.ascontiguousarray(x).view(np.int64)


def distinct_counts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and how often each occurs."""
    return np.unique(keys, return_counts=True)
