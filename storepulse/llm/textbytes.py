"""Vectorised access to the UTF-8 bytes of a string column inside Arrow tasks.

An Arrow string column is one byte buffer and an array of offsets, so numpy
can find words, lines and their hashes for a whole batch without building
Python strings.  Everything here works on blocks of rows of a bounded size
(``BLOCK_BYTES``, or one row if that is longer), so temporaries stay small.

Hashes are 64 bits wide.  Two different words share one with probability
2**-64, so a billion distinct words collide somewhere with about 3 %.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

BLOCK_BYTES = 2 << 20
LONG_WORD = 64  # bytes; longer spans are hashed one by one

_K1 = np.uint64(0x9E3779B97F4A7C15)
_K2 = np.uint64(0xBF58476D1CE4E5B9)
_K3 = np.uint64(0x94D049BB133111EB)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def column_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, at, data = column.buffers()
    n = len(column)
    offsets = np.frombuffer(at, np.int64)[column.offset:column.offset + n + 1] if n else np.zeros(1, np.int64)
    lo, hi = int(offsets[0]), int(offsets[-1])
    raw = np.frombuffer(data, np.uint8)[lo:hi] if hi > lo else np.zeros(0, np.uint8)
    return raw, offsets - lo


def row_blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes, or of one row."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi
        lo = hi


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of each block of a string column."""
    data, offsets = column_bytes(column)
    for lo, hi in row_blocks(offsets, limit):
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of the runs of True that do not cross a row's edge."""
    if not inside.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(inside.size + 1, bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of ``[^\\x20\\x09-\\x0D]+``."""
    return spans(~SPACE[data], offsets)


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of the \\n-split lines, empty ones left out."""
    return spans(data != 10, offsets)


def mixed(h: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    h = (h ^ (h >> np.uint64(30))) * _K2
    h = (h ^ (h >> np.uint64(27))) * _K3
    return h ^ (h >> np.uint64(31))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, eight bytes of all spans at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    wide = np.ndarray((len(data) + 1,), np.dtype("<u8"), padded.data, strides=(1,))
    size = ends - starts
    h = mixed(size.astype(np.uint64) * _K1)
    at, left = starts, np.minimum(size, LONG_WORD)
    active = np.flatnonzero(left > 0)
    while active.size:
        some = left[active]
        lane = wide[at[active]]
        short = some < 8
        lane[short] &= (np.uint64(1) << (some[short] * 8).astype(np.uint64)) - np.uint64(1)
        x = (h[active] ^ lane) * _K1
        h[active] = x ^ (x >> np.uint64(32))
        keep = some > 8
        active = active[keep]
        at = at.copy() if at is starts else at
        at[active] += 8
        left[active] -= 8
    for i in np.flatnonzero(size > LONG_WORD):
        h[i] = xxhash.xxh64_intdigest(data[starts[i]:ends[i]].tobytes(), 1)
    return mixed(h)


def per_row(rows: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Sum of ``weights`` (count, if None) by row index, as int64."""
    if weights is None:
        return np.bincount(rows, minlength=n).astype(np.int64)
    return np.bincount(rows, weights=weights, minlength=n).astype(np.int64)


def summed(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of True bytes in each row."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]
