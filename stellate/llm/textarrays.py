"""Array helpers for text inside Arrow batches.

Tasks that shingle, count or label words work on the raw UTF-8 bytes of a
slice of an Arrow column with numpy instead of looping over words.  A slice
holds about ``SLICE_BYTES`` of text (one document at least), so the memory of a
task is about 70 times the larger of that and the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_U = np.uint64

# Fixed odd multiplier of the rolling hash and its inverse modulo 2**64.
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_TABLE = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64)
_TABLE[65:91] = _TABLE[97:123]  # A-Z hash like a-z
_POWERS = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, 2 * SLICE_BYTES)
        for k, base in enumerate((_P, _P_INV)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (the public splitmix64 constants)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets) of runs of rows with about ``limit`` bytes; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_binary())
    n = len(column)
    if not n:
        return
    bufs = column.buffers()
    offs = np.frombuffer(bufs[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offs, offs[first] + limit, "right")) - 1
        end = min(n, max(end, first + 1))
        lo, hi = offs[first], offs[end]
        yield first, end, data[lo:hi], (offs[first : end + 1] - lo)
        first = end


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every whitespace-separated word, and word offsets by row."""
    space = _SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offs] = True
    inside = ~space
    before = np.ones(len(data), dtype=bool)
    before[1:] = space[:-1]
    after = np.ones(len(data), dtype=bool)
    after[:-1] = space[1:]
    start = np.flatnonzero(inside & (before | edge[:-1]))
    end = np.flatnonzero(inside & (after | edge[1:])) + 1
    return start, end, np.searchsorted(start, offs)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; A-Z count as a-z."""
    power, inverse = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_TABLE[data] * power[: len(data)], out=total[1:])
    h = (total[end] - total[start]) * inverse[start]
    return mix(h + (end - start).astype(np.uint64))


def packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Runs of a numeric array as binary values, so that a driver holds them without an object per number."""
    width = values.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * width).astype(np.int32).tobytes()), pa.py_buffer(values.tobytes())])


# Multipliers by position of a word in its shingle.
_PLACE = np.random.default_rng(77).integers(1, 1 << 63, 16, dtype=np.uint64) | _U(1)


def shingles(h: np.ndarray, woffs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every k-word shingle and shingle offsets by row.

    A row with fewer than k words (but one at least) has its whole sequence as one shingle.
    """
    count = np.diff(woffs)
    out = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    soffs = np.zeros(len(woffs), dtype=np.int64)
    np.cumsum(out, out=soffs[1:])
    row = np.repeat(np.arange(len(count)), out)
    at = np.arange(soffs[-1]) - soffs[row] + woffs[row]
    left = np.minimum(woffs[row + 1] - at, k)
    total = left.astype(np.uint64) * _U(0xD6E8FEB86659FD93)
    for i in range(k):
        ok = left > i
        total += np.where(ok, h[np.where(ok, at + i, 0)] if len(h) else 0, 0).astype(np.uint64) * _PLACE[i]
    return mix(total), soffs
