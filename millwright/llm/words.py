"""Vectorised word and span hashing over the bytes of many texts at once.

All separators that matter here are ASCII, so words can be found in UTF-8 bytes without
decoding. Span hashes are differences of a running polynomial over random byte values, taken
modulo 2**64 and mixed, so their cost does not depend on the length of the spans.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
_RANDOM = np.random.default_rng(20240607)
BYTE_VALUES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
MULTIPLIERS = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A") : ord("Z") + 1] += 32
FOLDED_VALUES = BYTE_VALUES[FOLD]
# Bytes of a word: everything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = np.ones(256, bool)
WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
# Bytes of a bare word: ASCII letters and digits, and every byte of a longer code point.
BARE = np.zeros(256, bool)
BARE[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("0"), ord("9") + 1), *range(128, 256)]] = True


class Words(NamedTuple):
    """Word spans of a slice; ``first[d]:first[d + 1]`` are the words of text ``d``."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def owner(self) -> np.ndarray:
        """Index of the text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with about ``limit`` bytes of text: first row, end row, bytes, offsets.

    A null counts as empty. A text longer than the limit makes a slice of its own, whole.
    """
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, where, data = column.buffers()
    if len(column) == 0:
        return
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def find_words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = WORD) -> Words:
    """Maximal runs of ``inside`` bytes that stay within one text."""
    n = len(data)
    if n == 0:
        return Words(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64))
    flags = inside[data]
    begins, stops = flags.copy(), flags.copy()
    begins[1:] &= ~flags[:-1]
    stops[:-1] &= ~flags[1:]
    heads = offsets[:-1][offsets[:-1] < n]
    tails = offsets[1:][offsets[1:] > 0] - 1
    begins[heads] = flags[heads]
    stops[tails] = flags[tails]
    starts = np.flatnonzero(begins)
    return Words(starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets))


def powers(n: int, base: int) -> np.ndarray:
    out = np.full(n + 1, base & (2**64 - 1), np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class SpanHasher:
    """Hashes of byte spans; keeps the powers of the base between slices."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, np.uint64)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
        n = len(data)
        if len(self.up) < n + 1:
            self.up, self.down = powers(n, BASE), powers(n, pow(BASE, -1, 2**64))
        running = np.zeros(n + 1, np.uint64)
        np.cumsum(values[data] * self.up[:n], out=running[1:])
        return mix((running[ends] - running[starts]) * self.down[starts])


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words; ``len(hashes) - size + 1`` values."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:n] * MULTIPLIERS[0]
    for j in range(1, size):
        total += hashes[j : j + n] * MULTIPLIERS[j]
    return mix(total)


def windows_in_texts(first: np.ndarray, size: int) -> np.ndarray:
    """Which of the windows of :func:`window_hashes` lie within one text."""
    n = int(first[-1]) - size + 1
    if n <= 0:
        return np.zeros(0, bool)
    room = np.repeat(first[1:], np.diff(first))
    return np.arange(n) + size <= room[:n]


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes of all entries of consecutive runs ``starts[k]:starts[k] + lengths[k]``."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)


def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` between consecutive bounds."""
    running = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=running[1:])
    return np.diff(running[bounds])
