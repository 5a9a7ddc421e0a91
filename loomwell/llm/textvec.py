"""Vectorised words and shingles: numpy over the UTF-8 buffers of Arrow string columns.

Separators are ASCII bytes, so byte-wise tests are exact in UTF-8. Word hashes are polynomial in
random 64-bit byte values with a final mix; hashes stand for words only where the pair-wise chance of a
collision (2**-64) is out of reach, and operators that must be exact compare the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

_RNG = np.random.default_rng(20_240_229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ODD = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)

#: `[\x20\x09-\x0D]` separates words.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: `[\x00-\x2F\x3A-\x60\x7B-\x7F]` separates words (after lower-casing A-Z).
NOT_ALNUM = np.zeros(256, dtype=bool)
NOT_ALNUM[0x00:0x30] = NOT_ALNUM[0x3A:0x61] = NOT_ALNUM[0x7B:0x80] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _S33)
    h = h * _M1
    h = h ^ (h >> _S33)
    h = h * _M2
    return h ^ (h >> _S33)


@dataclass
class Words:
    """Words of some rows: byte range and row of each, and the lower-cased bytes."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    #: Index of each row's first word, and its first byte; one more entry than rows.
    first: np.ndarray
    base: np.ndarray

    def hashes(self) -> np.ndarray:
        n = len(self.start)
        if not n:
            return np.zeros(0, dtype=np.uint64)
        length = self.end - self.start
        total = int(length.sum())
        offset = np.cumsum(length) - length
        within = np.arange(total, dtype=np.int64) - np.repeat(offset, length)
        at = within + np.repeat(self.start, length)
        longest = int(length.max())
        power = np.full(longest, _BASE, dtype=np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        values = _BYTE[self.data[at]] * power[within]
        return mix(np.add.reduceat(values, offset) + length.astype(np.uint64) * _M2)

    def text(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def slices(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes, one row at least, that bound the size of temporaries."""
    offsets = np.asarray(pa.compute.cumulative_sum(pa.compute.fill_null(pa.compute.binary_length(column), 0)).cast(pa.int64()))
    a, base = 0, 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, base + most, side="right")))
        yield a, b
        base, a = int(offsets[b - 1]), b


def words(column: pa.Array, separators: np.ndarray, lower: bool = True) -> Words:
    """Words of a string column (null: none)."""
    column = pa.compute.fill_null(column, "").cast(pa.large_string())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, dtype=np.uint8)
    offsets = offsets - offsets[0]
    if lower:
        data = _LOWER[data]
    inside = ~separators[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    return Words(data, start, end, np.searchsorted(start, offsets), offsets)


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on; callers drop the ones that leave their row."""
    if len(hashes) < k:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(hashes) - k + 1, dtype=np.uint64)
    for j in range(k):
        out += hashes[j : len(hashes) - k + 1 + j] * ODD[j % 64]
    return mix(out + np.uint64(k))
