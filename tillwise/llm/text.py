"""Words of many texts at once, on the bytes of Arrow batches.

A batch of texts is one run of UTF-8 bytes. Words are found and hashed in it by array
operations, so the tasks run no Python statement per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at a time; a longer text is a piece of its own.
PIECE_BYTES = 2 << 20
#: Bytes of text that are hashed at a time; a longer word is hashed alone.
HASHED_BYTES = 1 << 18

_U = np.uint64
#: An odd base whose predecessor is twice an odd number, so swapped letters keep apart.
_BASE = 0x9E3779B97F4A7C17 | 3
_LETTERS, _OTHER_LETTERS = (
    np.random.Generator(np.random.PCG64(seed)).integers(0, 2**64, 256, dtype=np.uint64) for seed in (20240607, 20240711)
)


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """256 flags, true inside the inclusive ranges."""
    flags = np.zeros(256, dtype=bool)
    for first, last in ranges:
        flags[first : last + 1] = True
    return flags


#: `[^\x20\x09-\x0D]+`
SPACED = ~byte_set((0x20, 0x20), (0x09, 0x0D))
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing
ALNUM = byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: bytes with A-Z lower-cased
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def release() -> None:
    """Give freed memory back to the machine: a worker lives on for other stages beside others."""
    global _powers, _inverse
    if len(_powers) > 4 * HASHED_BYTES:
        # left by a very long text
        _powers, _inverse = _powers[: HASHED_BYTES + 1].copy(), _inverse[: HASHED_BYTES + 1].copy()
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


#: glibc keeps what is freed between blocks in use; elsewhere there is no such function.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text at most, but one row at least."""
    rows = batch.num_rows
    if not rows:
        return
    _, at = texts_of(batch.column(column))
    first = 0
    while first < rows:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield batch.slice(first, min(last, rows) - first)
        first = min(last, rows)
    release()


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit over all 64."""
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse
    if len(_powers) < n:
        size = max(n, HASHED_BYTES + 1)
        with np.errstate(over="ignore"):
            step = np.full(size, _BASE, np.uint64)
            step[0] = 1
            _powers = np.cumprod(step)
            step[1:] = pow(_BASE, -1, 1 << 64)
            _inverse = np.cumprod(step)
    return _powers, _inverse


class Words:
    """The words of a run of texts.

    ``start, end`` are byte positions, ``first`` the number of words before each text (one
    entry more than texts), ``hash`` 64-bit hashes that depend on the word alone.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray):
        flags = np.zeros(len(data) + 2, bool)
        flags[1:-1] = inside[data]
        edge = flags[1:] != flags[:-1]
        # where texts touch, a word of the one ends and a word of the next may begin
        border = offsets[1:-1]
        touching = np.unique(border[flags[border] & flags[border + 1]]) if len(border) else border
        self.start = np.flatnonzero(edge & flags[1:])
        self.end = np.flatnonzero(edge & flags[:-1])
        if len(touching):
            self.start = np.sort(np.concatenate([self.start, touching]))
            self.end = np.sort(np.concatenate([self.end, touching]))
        self.first = np.searchsorted(self.start, offsets)
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        """The number of the text that each word belongs to."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    @property
    def hash(self) -> np.ndarray:
        return self._hash(_LETTERS)

    @property
    def second_hash(self) -> np.ndarray:
        """64 more bits of another function of the words."""
        return self._hash(_OTHER_LETTERS)

    def _hash(self, letters: np.ndarray) -> np.ndarray:
        out, first = np.empty(len(self), np.uint64), 0
        while first < len(self):
            low = int(self.start[first])
            last = max(first + 1, int(np.searchsorted(self.end, low + HASHED_BYTES, "right")))
            size = int(self.end[last - 1]) - low
            start, end = self.start[first:last] - low, self.end[first:last] - low
            with np.errstate(over="ignore"):
                power, inverse = _power_tables(size + 1)
                sums = np.zeros(size + 1, np.uint64)
                np.cumsum(letters[self.data[low : low + size]] * power[:size], out=sums[1:])
                out[first:last] = mix((sums[end] - sums[start]) * inverse[start])
            first = last
        return out

    def windows(self, size: int) -> np.ndarray:
        """True where a window of so many words of one text starts."""
        n = len(self)
        left = np.repeat(self.first[1:], self.counts) - np.arange(n)
        return left >= size


def window_hash(hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Order-dependent hashes of ``size`` neighbours, for every start; the last ones are short."""
    with np.errstate(over="ignore"):
        n, out = len(hashes), np.full(len(hashes), seed, np.uint64)
        for k in range(size):
            factor = _U(pow(0xC2B2AE3D27D4EB4F + 2 * seed, k + 1, 1 << 64))
            out[: max(n - k, 0)] += hashes[k:] * factor
        return mix(out)


def covered(starts: np.ndarray, size: int) -> np.ndarray:
    """True for every position that a flagged window of ``size`` covers."""
    n = len(starts)
    ends = np.zeros(n + 1, np.int64)
    ends[:n] = starts
    sums = np.concatenate([[0], np.cumsum(ends[:n])])
    return sums[np.arange(1, n + 1)] > sums[np.maximum(np.arange(1, n + 1) - size, 0)]
