"""Texts of an Arrow batch as one byte buffer, and words, word hashes and shingles of it in numpy.

A batch is cut at document boundaries into chunks of about CHUNK bytes, so that the arrays of
eight bytes a position stay small however many rows a batch has. Word hashes are polynomial over
random 64-bit values a byte, modulo 2**64, and then mixed.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 19
BLOCK = 1 << 19
U = np.uint64

#: Separators \x20 and \x09-\x0D.
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: Everything in ASCII but digits and letters (judged after lower-casing).
NOT_ALNUM = np.zeros(256, dtype=bool)
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
BYTE_VALUE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)


def tidied(step: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The step, after which the worker's freed memory goes back to the system: workers outlive their tasks."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from step(batches)
        finally:
            tidy()

    return run


def tidied_group(step: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """The same for a function of one group."""

    def run(table: pa.Table) -> pa.Table:
        try:
            return step(table)
        finally:
            tidy()

    return run


def tidied_pair(step: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The same for a function of two groups of one key."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return step(left, right)
        finally:
            tidy()

    return run


def tidy() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes): row i is bytes[offsets[i]:offsets[i + 1]]; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, where, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(len(column) + 1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    offsets = np.frombuffer(where, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return offsets - offsets[0], np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]


def chunks(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges [lo, hi) of at most limit bytes, or of one longer row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


@cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        p, step = np.ones(1 << bits, dtype=np.uint64), base
        for k in range(bits):
            p[1 << k : 2 << k] = p[: 1 << k] * U(step)
            step = step * step % (1 << 64)
        out.append(p)
    return out[0], out[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def word_spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): spans of words; row i has words first[i] to first[i + 1]."""
    n = len(data)
    inside = ~separators[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    edge[n] = True
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:n]
    end[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes; spans are ordered and don't overlap."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + BLOCK, "right")))
        values = BYTE_VALUE[data[base : ends[j - 1]]]
        powers, inverse = _powers(max(19, int(len(values)).bit_length()))
        sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * powers[: len(values)], out=sums[1:])
        s = starts[i:j] - base
        out[i:j] = (sums[ends[i:j] - base] - sums[s]) * inverse[s]
        i = j
    return mix(out)


_STEPS = mix(np.arange(1, 65, dtype=np.uint64)) | U(1)


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, rows): one for each k consecutive words of a row.

    A row of 1 to k - 1 words has one shingle, its whole sequence.
    """
    n = np.diff(first)
    grams = np.zeros(max(len(words) - k + 1, 0), dtype=np.uint64)
    for j in range(k):
        grams += words[j : j + len(grams)] * _STEPS[j % 64]
    row = np.repeat(np.arange(len(n)), n)
    full = np.arange(len(grams)) + k <= first[1:][row[: len(grams)]]
    hashes, rows = mix(grams[full]), row[: len(grams)][full]
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        values = np.zeros(len(short), dtype=np.uint64)
        for j in range(k - 1):
            has = n[short] > j
            values[has] += words[first[short][has] + j] * _STEPS[j % 64]
        hashes = np.concatenate([hashes, mix(values ^ U(0xA5A5A5A5A5A5A5A5))])
        rows = np.concatenate([rows, short])
        order = np.argsort(rows, kind="stable")
        hashes, rows = hashes[order], rows[order]
    return hashes, rows
