"""Vectorised views of the texts in an Arrow batch: byte slices, words, lines and their 64-bit hashes.

All functions work on UTF-8 bytes. A batch is cut into slices of a few megabytes, so memory is bounded by the slice (or
by one document, if that is larger), whatever the number of rows in the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the finalizer of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Slice:
    """Documents ``first .. first + n`` of a batch: ``data`` holds their bytes, ``offsets`` (n + 1) their borders."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray):
        self.first, self.data, self.offsets = first, data, offsets
        self.n = len(offsets) - 1

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.offsets)

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()

    def take(self, picked: np.ndarray) -> Slice:
        """The picked documents as a slice of their own."""
        offsets = np.concatenate([[0], np.cumsum(self.lengths[picked])])
        parts = [self.data[self.offsets[i]:self.offsets[i + 1]] for i in picked]
        return Slice(0, np.concatenate(parts) if parts else self.data[:0], offsets)

    def per_doc(self, mask: np.ndarray) -> np.ndarray:
        """How many bytes of each document the mask marks."""
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and document of each maximal run of marked bytes within a document."""
        edge = np.zeros(len(inside) + 1, bool)
        edge[self.offsets] = True
        before = np.concatenate([[False], inside[:-1]]) if len(inside) else inside
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.concatenate([inside[1:], [False]]) if len(inside) else inside
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        return starts, ends, np.searchsorted(self.offsets, starts, "right") - 1


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Consecutive slices that cover the column; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield Slice(first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last


@lru_cache(maxsize=8)
def _tables(seed: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    base = int(rng.integers(1, 1 << 62)) * 8 + 5
    inverse = pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        powers, inverses = (np.cumprod(np.where(np.arange(size + 1) > 0, np.uint64(x % (1 << 64)), np.uint64(1)))
                            for x in (base, inverse))
    return rng.integers(0, 1 << 63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1), powers, inverses


class Hasher:
    """Hashes of any byte ranges of ``data`` from prefix sums of ``byte value x base^position`` modulo 2^64."""

    def __init__(self, data: np.ndarray, seed: int = 1):
        size = 1 << max(16, int(len(data)).bit_length())
        values, powers, self.inverses = _tables(seed, size)
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(values[data] * powers[:len(data)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            raw = (self.sums[ends] - self.sums[starts]) * self.inverses[starts]
            return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def grams(hashes: np.ndarray, docs: np.ndarray, n: int, skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive words (with ``skip`` words left out between each two), and where each begins.

    Sequences that cross a document are left out.
    """
    step = skip + 1
    count = len(hashes) - (n - 1) * step
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        out = hashes[:count].copy()
        for k in range(1, n):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k * step:k * step + count] + np.uint64(skip))
    at = np.flatnonzero(docs[:count] == docs[(n - 1) * step:])
    return out[at], at


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which entries have an equal entry elsewhere."""
    order = np.argsort(keys)
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def covered(starts: np.ndarray, length: int, total: int) -> np.ndarray:
    """Which of ``total`` positions lie in one of the ranges ``start .. start + length``."""
    depth = np.zeros(total + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, np.minimum(starts + length, total), -1)
    return np.cumsum(depth[:-1]) > 0
