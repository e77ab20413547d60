"""Arrow text columns as byte arrays, and hashes of all their words at once.

Python tasks see a column of texts as one run of UTF-8 bytes plus the offset of
each text, cut into blocks of bounded size. Words and word windows are found
and hashed for a whole block by array operations, never text by text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20

#: The bytes that end a word, [\x20\x09-\x0D].
SEPARATORS = np.zeros(256, bool)
SEPARATORS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: A-Z to a-z, all other bytes as they are.
LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[ord("A") : ord("Z") + 1] += 32


class Block(NamedTuple):
    """Rows ``first`` to ``first + len(offsets) - 1`` of a batch."""

    first: int
    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64; text i is data[offsets[i]:offsets[i + 1]]


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a text column into blocks; null counts as an empty text."""
    if len(column) == 0:
        return
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(ends, kind)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    start, rows = 0, len(column)
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), rows)
        own = offsets[start : stop + 1]
        yield Block(start, raw[own[0] : own[-1]], own - own[0])
        start = stop


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that all bits depend on all others."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


class Rolling:
    """Hash of any run of symbols in constant time, from sums of powers modulo 2**64.

    Two objects with different seeds give independent hashes.
    """

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.base = np.uint64(int(rng.integers(0, 2**62)) * 4 + 3)
        self.inverse = np.uint64(pow(int(self.base), -1, 2**64))
        self.symbols = rng.integers(0, 2**64, 256, dtype=np.uint64)
        self.powers = np.ones(1, np.uint64)
        self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            steps = np.full(n + n // 4 + 1024, self.base, np.uint64)
            steps[0] = 1
            self.powers = np.multiply.accumulate(steps)
            steps = np.full(len(steps), self.inverse, np.uint64)
            steps[0] = 1
            self.inverses = np.multiply.accumulate(steps)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """One more than ``values``: sums of value * power before each place."""
        self._grow(len(values) + 1)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.powers[: len(values)], out=out[1:])
        return out

    def of_bytes(self, data: np.ndarray) -> np.ndarray:
        return self.sums(self.symbols[data])

    def runs(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of values[start:end] for each pair; the length is part of it."""
        h = (sums[ends] - sums[starts]) * self.inverses[starts]
        return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


@lru_cache(maxsize=8)
def rolling(seed: int) -> Rolling:
    """One object per process and seed, so that the powers are computed once."""
    return Rolling(seed)


class Words(NamedTuple):
    starts: np.ndarray  # byte of each word's start in the block
    ends: np.ndarray
    text: np.ndarray  # the text each word belongs to
    first: np.ndarray  # one more than texts: index of each text's first word


def find_words(
    data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SEPARATORS
) -> Words:
    """Maximal runs of bytes that are not separators; none crosses two texts."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(len(offsets), np.int64))
    inside = ~separators[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < n]
    begins[heads] = inside[heads]
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    finishes[tails] = inside[tails]
    starts = np.flatnonzero(begins)
    first = np.searchsorted(starts, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(starts, np.flatnonzero(finishes) + 1, text, first)


def word_hashes(data: np.ndarray, words: Words, seed: int) -> np.ndarray:
    r = rolling(seed)
    return r.runs(r.of_bytes(data), words.starts, words.ends)


def window_starts(counts_first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a run of ``length`` symbols of one text starts, and their texts.

    ``counts_first`` holds each text's first symbol, and the number of all at its end.
    """
    sizes = np.maximum(np.diff(counts_first) - length + 1, 0)
    text = np.repeat(np.arange(len(sizes)), sizes)
    before = np.cumsum(sizes) - sizes
    starts = np.arange(int(sizes.sum())) - before[text] + counts_first[:-1][text]
    return starts, text


def ragged(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from all values in a row and the length of each list."""
    ends = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))
