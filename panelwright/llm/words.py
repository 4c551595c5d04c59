"""Words of Arrow text columns as numpy arrays: boundaries, 64-bit hashes, n-gram hashes.

A word is a run of bytes other than space, tab, LF, VT, FF and CR.  Nothing here
keeps state between calls, and no step loops over words in Python.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits (a bijection)."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U(33))
    h = h * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
_BASE = U(0xD6E8FEB86659FD93)
_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        more = np.full(max(n, 64), _BASE, np.uint64)
        more[0] = 1
        _POWERS = np.cumprod(more, dtype=np.uint64)
    return _POWERS


def trimmed(run: Callable) -> Callable:
    """``run`` for mapInArrow, after which the worker returns the memory it no longer uses; Spark keeps workers for later tasks."""

    def and_trim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim:
            trim(0)

    return and_trim


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, byte offsets of the rows); nulls count as empty.

    A slice holds at most ``limit`` bytes, or one longer text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1 + column.offset)[column.offset :]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    first = 0
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def split_words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the index of each text's first word (one more at the end)."""
    if not len(buf):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~SPACE[buf]
    joined = np.zeros(len(buf) + 1, bool)  # byte i - 1 and byte i belong to one word
    joined[1:-1] = solid[1:] & solid[:-1]
    joined[offsets] = False
    starts = np.flatnonzero(solid & ~joined[:-1])
    ends = np.flatnonzero(solid & ~joined[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each (not empty) span of bytes."""
    if not len(starts):
        return np.empty(0, np.uint64)
    length = ends - starts
    before = np.cumsum(length) - length
    inside = np.arange(int(length.sum()), dtype=np.int64) - np.repeat(before, length)
    taken = buf[inside + np.repeat(starts, length)]
    value = _BYTE[taken] * _powers(int(length.max()))[inside]
    return mix(np.add.reduceat(value, before) + length.astype(np.uint64) * U(0x9E3779B97F4A7C15))


def ngrams(h: np.ndarray, k: int, base: int = 0x9E3779B97F4A7C13) -> np.ndarray:
    """Hashes of all runs of k neighbours, also those that cross texts."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * U(base) + h[j : j + n]
    return mix(out)


def owners(bounds: np.ndarray) -> np.ndarray:
    """The text each word belongs to."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def longs(column: pa.Array, null: int = np.iinfo(np.int64).max) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.int64()).fill_null(null).to_numpy(zero_copy_only=False)


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the number of values of each row."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
