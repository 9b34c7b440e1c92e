"""Numpy helpers over Arrow text columns: words, word hashes and word windows.

They work on the UTF-8 bytes of whole Arrow columns, so no Python string is made per word. Words are
runs of bytes outside ``\\x20`` and ``\\x09``-``\\x0D`` (every other byte, also of multi-byte
characters, is part of a word). Hashes are 64 bits wide and the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

U64 = np.uint64
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

#: Bytes hashed in one go: bounds the 8-byte work arrays, whatever a text's length.
SEGMENT = 1 << 18

_R = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]
_MIX = [U64(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93)]


def fmix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit hashes."""
    h = (h ^ (h >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """r^i and r^-i modulo 2^64 for i < n; kept between calls."""
    if len(_POWERS[0]) < n:
        for k, r in enumerate((_R, pow(_R, -1, 1 << 64))):
            p = np.full(n, r, U64)
            p[0] = 1
            _POWERS[k] = np.cumprod(p)
    return _POWERS[0], _POWERS[1]


def bounded_batches(spark: SparkSession, rows: int = 1000, size: int = 1 << 22) -> None:
    """Hand Python workers at most ``rows`` rows at a time, and no further row once a batch has ``size`` bytes, however long
    texts or packed columns are: the batch lies outside the heap in the JVM and again in the worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column, without a copy; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    _, offsets, data = column.buffers()
    wide = np.int64 if column.type in (pa.large_string(), pa.large_binary()) else np.int32
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, wide)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def slices(offsets: np.ndarray, most: int = SEGMENT) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes each (a longer text is a range of its own)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and each text's first word (len(offsets) entries).

    ``offsets`` are relative to ``data``; words never reach over the end of a text.
    """
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    solid = ~IS_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins, stops = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:n]
    stops[:-1] &= ~solid[1:] | edge[1:n]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word: a polynomial of its bytes, mixed with its length."""
    out, i = np.empty(len(starts), U64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SEGMENT, "right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        up, down = _powers(hi - lo)
        total = np.empty(hi - lo + 1, U64)
        total[0] = 0
        np.cumsum((data[lo:hi].astype(U64) + U64(1)) * up[:hi - lo], out=total[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = fmix((total[e] - total[s]) * down[s] + (e - s).astype(U64) * _MIX[4])
        i = j
    return out


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` word hashes (over text borders too: callers cut there)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    s = h[:n] * _MIX[0]
    for j in range(1, k):
        s = (s ^ (s >> U64(29))) * _MIX[j % 4] + h[j:j + n]
    return fmix(s)


def sorted_distinct(a: np.ndarray) -> np.ndarray:
    a = np.sort(a)
    return a[np.concatenate(([True], a[1:] != a[:-1]))] if len(a) else a
