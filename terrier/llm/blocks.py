"""Bounded blocks of texts as byte arrays, shared by the operators that work in Arrow batches.

A block joins whole texts, each followed by a line break, into one byte array, so
that words and lines are found for thousands of texts at once. NULL texts are empty.
A block closes before it passes ``limit`` bytes; a longer text is a block of its own,
so nothing is ever cut.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; the same everywhere and in every run."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        size = 1 << max(10, int(n).bit_length())
        _POWERS = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, _PRIME)]))
    return _POWERS


class Block:
    """Texts of some rows as bytes; see the module's docstring."""

    def __init__(self, rows: pa.RecordBatch, column: str, lower: bool = False):
        texts = rows.column(column).cast(pa.large_string())
        texts = pc.fill_null(texts, "")
        joined = pc.binary_join_element_wise(texts, pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
        buffers = joined.buffers()
        self.rows = rows
        self.count = len(rows)
        self.offsets = np.frombuffer(buffers[1], np.int64)[joined.offset: joined.offset + self.count + 1]
        self.data = np.frombuffer(buffers[2], np.uint8)[: self.offsets[-1]]
        if lower:
            self.data = LOWER[self.data]

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]: self.offsets[i + 1] - 1].tobytes()

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text are flagged."""
        return np.add.reduceat(flags, self.offsets[:-1], dtype=np.int64)

    def split(self, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the runs of bytes that are no separators."""
        inside = ~separator[self.data]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            edges = np.concatenate([np.zeros(1, edges.dtype), edges])
        return edges[::2], edges[1::2]

    @cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of words, in order; none spans two texts."""
        return self.split(WHITE)

    def counts(self, starts: np.ndarray) -> np.ndarray:
        """How many of the given places lie in each text."""
        return np.diff(np.searchsorted(starts, self.offsets))

    def owners(self, starts: np.ndarray) -> np.ndarray:
        """The text of each of the given places."""
        return np.repeat(np.arange(self.count), self.counts(starts))

    def codes(self, starts: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """Distinct byte strings among the given runs, and each run's place among them."""
        if not len(starts):
            return pa.array([], pa.large_binary()), np.zeros(0, np.int32)
        edges = np.empty(2 * len(starts) + 1, np.int64)
        edges[:-1:2], edges[1::2], edges[-1] = starts, ends, ends[-1]
        runs = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(self.data)])
        taken = runs.dictionary_encode()
        codes = taken.indices.to_numpy()[::2]
        used = np.zeros(len(taken.dictionary), bool)
        used[codes] = True
        place = np.cumsum(used, dtype=np.int32) - 1
        return taken.dictionary.filter(pa.array(used)), place[codes]

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each run's bytes."""
        if not len(starts):
            return np.zeros(0, np.uint64)
        lengths = ends - starts
        at = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        weights = powers(int(lengths.max()))[at - np.repeat(starts, lengths)]
        first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        return mix(np.add.reduceat((self.data[at].astype(np.uint64) + np.uint64(1)) * weights, first) + lengths.astype(np.uint64))


def blocks(batches: Iterable[pa.RecordBatch], column: str, limit: int = 4 << 20, lower: bool = False) -> Iterator[Block]:
    """Blocks of whole texts from Arrow batches, in their order."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, size in enumerate(sizes):
            if i > start and total + size > limit:
                yield Block(batch.slice(start, i - start), column, lower)
                start, total = i, 0
            total += int(size) + 1
        if len(batch) > start:
            yield Block(batch.slice(start), column, lower)


def grams(values: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n consecutive values; entry i covers i to i + n - 1."""
    if len(values) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(values) - n + 1, np.uint64)
    for k in range(n):
        out = out * _PRIME + values[k: len(values) - n + 1 + k]
    return mix(out)


def whole_windows(counts: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which places begin n values of one text; ``counts`` are values per text."""
    keep = np.ones(max(0, total - n + 1), bool)
    ends = np.cumsum(counts)[:-1]
    for k in range(1, n):
        at = ends - k
        keep[at[(at >= 0) & (at < len(keep))]] = False
    return keep
