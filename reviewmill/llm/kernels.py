"""Array kernels that run inside tasks: texts as byte arrays, prefix hashes, words and sliding minima.

Everything works on a chunk of whole texts laid end to end. A chunk holds about ``CHUNK_BYTES``
(or one longer text), so a worker's memory follows the longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
PRIME = (1 << 31) - 1
#: space and the five control characters from tab to carriage return
BREAKS = np.zeros(256, bool)
BREAKS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; a null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data, offsets


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have about ``limit`` bytes together; never an empty range."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        yield low, min(high, rows)
        low = min(high, rows)


@lru_cache(maxsize=2)
def _powers(size: int, base: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, base, np.uint64)]))


def powers(size: int, base: int = BASE) -> np.ndarray:
    """Powers of an odd base modulo 2**64, at least ``size`` of them."""
    room = 1 << max(20, int(size).bit_length())
    if room > 1 << 22:  # for one very long text; not kept
        return _powers.__wrapped__(room, base)
    return (_forward if base == BASE else _backward)(room)


@lru_cache(maxsize=1)
def _forward(room: int) -> np.ndarray:
    return _powers.__wrapped__(room, BASE)


@lru_cache(maxsize=1)
def _backward(room: int) -> np.ndarray:
    return _powers.__wrapped__(room, INVERSE)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PrefixHash:
    """Prefix sums of ``value[i] * BASE**i`` modulo 2**64: any span's hash in constant time."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values.astype(np.uint64, copy=False) * powers(n)[:n], out=self.sums[1:])
        self.back = powers(n, INVERSE)

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])

    def spans_of(self, width: int) -> np.ndarray:
        """Hashes of all spans of one width, by start."""
        n = len(self.sums) - 1 - width
        if n < 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[width:] - self.sums[: n + 1]) * self.back[: n + 1])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by start."""
    if len(values) < width:
        return values[:0]
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def words(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = BREAKS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end (in ``data``, which begins at ``offsets[0]``) of every word, and the first
    word of each row as offsets. A word is a run of bytes that are not ``breaks``."""
    inside = ~breaks[data]
    before = np.empty(len(data) + 1, bool)
    before[0], before[1:] = False, inside
    after = np.empty(len(data) + 1, bool)
    after[-1], after[:-1] = False, inside
    cuts = (offsets - offsets[0])[1:-1]
    starts = after & ~before
    ends = before & ~after
    split = cuts[(cuts > 0) & (cuts < len(data))]
    split = split[inside[split] & inside[split - 1]]  # two texts meet without a break
    starts[split] = ends[split] = True
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends)
    return starts, ends, np.searchsorted(starts, offsets - offsets[0])


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values."""
    edges = np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def covered(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` positions lie in one of the half-open spans."""
    marks = np.zeros(size + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, ends, -1)
    return np.cumsum(marks[:-1]) > 0


def change_points(*columns: np.ndarray) -> np.ndarray:
    """Positions at which a new run of equal rows begins."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def list_array(values: pa.Array, lengths: np.ndarray) -> pa.Array:
    """A list column from flat values and the length of each row's list."""
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), values)
