"""Words of whole texts as byte spans and 64-bit hashes, vectorised over an Arrow batch."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
#: Bytes handled at once by the steps that need several machine words per byte.
PIECE = 1 << 18

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
_LINE = 65521
_POWER = np.cumprod(np.full(_LINE, 0x9E3779B97F4A7C15, dtype=U64))
_STRIDE = np.append(U64(1), np.cumprod(np.full(4095, 0xC2B2AE3D27D4EB4F, dtype=U64)))
_STEP = U64(0x9FB21C651E98DF25)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Separators of the words [^\x20\x09-\x0D]+ and [^\x00-\x2F\x3A-\x60\x7B-\x7F]+.
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[0:0x30] = PUNCTUATION[0x3A:0x61] = PUNCTUATION[0x7B:0x80] = True


def frugal(task: Task) -> Task:
    """The same task over Arrow batches, giving freed memory back to the system while it runs and at its end:
    the worker's process lives on and would hold it through later stages."""

    @functools.wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for k, out in enumerate(task(batches), 1):
                yield out
                if k % 8 == 0:
                    _give_back()
        finally:
            _give_back()

    return run


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only in the GNU C library
    if trim:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def slices(column: pa.Array, most: int = 1 << 22) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows lo..hi of a text column with their bytes and the bounds of each row in them. A slice holds at
    most ``most`` bytes unless it is a single text. A null text is empty."""
    if len(column) == 0:
        return
    column = column.cast(pa.large_string()).fill_null("")
    _, at, data = column.buffers()
    bounds = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + most, "right")) - 1)
        yield lo, hi, data[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo]
        lo = hi


def spans(data: np.ndarray, bounds: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every maximal run of bytes that are no separators."""
    inside = ~separators[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = bounds[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    first[edge] = inside[edge]
    last[edge - 1] = inside[edge - 1]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(bounds, start, "right") - 1


def lines(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every line of every text, empty ones too; a text has one line more than line feeds."""
    feed = np.flatnonzero(data == 10)
    row = np.searchsorted(bounds, feed, "right") - 1
    every = np.arange(len(bounds) - 1)
    rows = np.concatenate([every, row])
    start, end = np.concatenate([bounds[:-1], feed + 1]), np.concatenate([bounds[1:], feed])
    by_start, by_end = np.lexsort((start, rows)), np.lexsort((end, rows))
    return start[by_start], end[by_end], rows[by_start]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the bytes of every span; the spans are in order and do not overlap."""
    out = np.empty(len(start), U64)
    lo = 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(end, start[lo] + PIECE, "right")))
        total, at = U64(0), int(start[lo])
        if hi == lo + 1 and end[lo] - at > PIECE:  # one very long span, in parts
            for k, p in enumerate(range(at, int(end[lo]), _LINE)):
                part = data[p : min(p + _LINE, int(end[lo]))]
                total = total + (_BYTE[part] * _POWER[: len(part)]).sum(dtype=U64) * _STRIDE[k % 4096]
            out[lo] = total
        else:
            size = end[lo:hi] - start[lo:hi]
            empty = size == 0
            size = np.maximum(size, 1)
            begin = np.concatenate([[0], np.cumsum(size)[:-1]])
            place = np.arange(begin[-1] + size[-1]) - np.repeat(begin, size)
            index = np.repeat(start[lo:hi], size) + place
            if empty.any():
                index = np.minimum(index, max(len(data) - 1, 0))
            value = _BYTE[data[index]] if len(data) else np.zeros(len(index), U64)
            value *= _POWER[place % _LINE]
            if size.max() > _LINE:
                value *= _STRIDE[(place // _LINE) % 4096]
            out[lo:hi] = np.where(empty, U64(0), np.add.reduceat(value, begin))
        lo = hi
    return mix(out + (end - start).astype(U64) * _STEP)


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n consecutive words, whatever text they belong to."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, U64)
    total = np.zeros(count, U64)
    for k in range(n):
        total *= _STEP
        total += words[k : k + count]
    return mix(total + U64(n))


def counts(row: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(row, minlength=rows).astype(np.int64)


def covered(hit: np.ndarray, n: int, total: int) -> np.ndarray:
    """Words inside a window of n words that begins at a hit."""
    delta = np.zeros(total + 1, np.int32)
    at = np.flatnonzero(hit)
    np.add.at(delta, at, 1)
    np.add.at(delta, at + n, -1)
    return np.cumsum(delta[:-1]) > 0


def lists(values: np.ndarray, per_row: np.ndarray, kind=None) -> pa.Array:
    """List column with per_row values for each row."""
    offsets = np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind) if kind else pa.array(values))
