"""Benchmark decontamination by Wu-Manber search for many word windows at once.

Symbols are words. The test windows (10 consecutive words of an item; an item of fewer words is one window) of one
length form a table set: a shift table by the hash of a word pair says how far the search may jump, windows are kept in
buckets by the hash of their last pair, and a candidate counts only if its words agree. A batch of documents is cut
into lanes that overlap by a window less one word; all lanes advance together in vectorised steps, each by its own jump.

The test strings are a stated query set: they are read in blocks of at most ``BLOCK_WINDOWS`` windows and item ids (some
tens of MB, whatever the size of the benchmark and however many items share a window), each block is broadcast, and one map over the documents per block adds its hits to
the row. Nothing is shuffled.

Edge cases: null and empty texts have no words; an item without words has no window; items with equal windows are all
reported; null item ids are reported as the text ``null``; repeated documents get equal rows; an empty benchmark hits
nothing; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.frames import col, field, unused, with_columns
from strata.llm.text import Hasher, Slice, slices

WINDOW = 10
BLOCK_WINDOWS = 200_000
CANDIDATES = 1 << 21  # candidate occurrences that are compared at once
LANE = 256

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def words_of(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and start, end and document of each word."""
    data = LOWER[part.data]
    return (data, *part.runs(WORD[data]))


class Windows:
    """Search tables for the windows of one length in words."""

    def __init__(self, length: int, rows: dict[tuple[bytes, ...], list[str]], ids: dict[bytes, int]):
        self.length, self.pair = length, min(2, length)
        self.texts = list(rows)
        self.items = list(rows.values())
        symbols = np.array([[ids[w] for w in t] for t in self.texts], np.int64)
        self.symbols = symbols
        self.mask = (1 << max(12, int(4 * len(self.texts) * length).bit_length())) - 1
        # Shift table: how far the end of the search window may move, by the hash of the pair at its end.
        self.shift = np.full(self.mask + 1, length - self.pair + 1, np.int16)
        for end in range(self.pair, length + 1):
            at = self.hash(symbols[:, end - self.pair:end])
            np.minimum.at(self.shift, at, length - end)
        # Buckets of windows by the hash of their last pair.
        last = self.hash(symbols[:, -self.pair:])
        self.order = np.argsort(last, kind="stable")
        self.keys, self.first, self.count = np.unique(last[self.order], return_index=True, return_counts=True)

    def hash(self, pairs: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = pairs[..., 0].astype(np.uint64)
            for k in range(1, pairs.shape[-1]):
                h = h * np.uint64(0x9E3779B97F4A7C15) + pairs[..., k].astype(np.uint64)
            h *= np.uint64(0xD6E8FEB86659FD93)
        return ((h >> np.uint64(32)) & np.uint64(self.mask)).astype(np.int64)

    def search(self, words: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window) of all occurrences of the windows' symbols within documents. ``words``: symbols."""
        m = self.length
        total = len(words)
        if total < m:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        starts = np.arange(0, total - m + 1, LANE)
        at, until = starts + m - 1, np.minimum(starts + LANE + m - 1, total)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(at):
            pairs = np.stack([words[at - k] for k in range(self.pair - 1, -1, -1)], axis=1)
            h = self.hash(pairs)
            jump = self.shift[h].astype(np.int64)
            hit = jump == 0
            if hit.any():
                found.append(self._confirmed(words, docs, at[hit], h[hit]))
            at = at + np.maximum(jump, 1)
            going = at < until
            at, until = at[going], until[going]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])

    def _confirmed(self, words, docs, ends, hashes) -> tuple[np.ndarray, np.ndarray]:
        m = self.length
        slot = np.searchsorted(self.keys, hashes)
        there = (slot < len(self.keys)) & (self.keys[np.minimum(slot, len(self.keys) - 1)] == hashes)
        there &= docs[ends] == docs[ends - m + 1]
        ends, slot = ends[there], slot[there]
        n = self.count[slot]
        if len(ends) > 1 and n.sum() > CANDIDATES:
            half = len(ends) // 2
            parts = [self._confirmed(words, docs, ends[at], hashes[there][at])
                     for at in (slice(0, half), slice(half, None))]
            return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        ends = np.repeat(ends, n)
        within = np.arange(len(ends)) - np.repeat(np.cumsum(n) - n, n)
        window = self.order[np.repeat(self.first[slot], n) + within]
        keep = np.arange(len(ends))
        for k in (0, *range(m - 1, 0, -1)):  # first word, then backwards
            keep = keep[words[ends[keep] - m + 1 + k] == self.symbols[window[keep], k]]
        return ends[keep] - m + 1, window[keep]


class Block:
    """One block of test windows, with the vocabulary they use."""

    def __init__(self, rows: dict[tuple[bytes, ...], list[str]]):
        vocabulary = sorted({w for t in rows for w in t})
        ids = {w: k + 1 for k, w in enumerate(vocabulary)}
        ends = np.cumsum([len(w) for w in vocabulary])
        data = np.frombuffer(b"".join(vocabulary), np.uint8)
        hashes = Hasher(data)(ends - [len(w) for w in vocabulary], ends) if vocabulary else np.zeros(0, np.uint64)
        self.by_hash = np.argsort(hashes)
        self.hashes = hashes[self.by_hash]
        lengths = sorted({len(t) for t in rows})
        self.tables = [Windows(n, {t: i for t, i in rows.items() if len(t) == n}, ids) for n in lengths]

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Word symbols by hash; 0 for words that no test string has."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.by_hash[at] + 1, 0)

    def occurrences(self, part: Slice) -> tuple[np.ndarray, dict[int, list[tuple[int, int, list[str]]]]]:
        """Words of each document; per document the (first word, end, items) of the windows that occur in it."""
        data, starts, ends, docs = words_of(part)
        counts = np.bincount(docs, minlength=part.n)
        begin = np.concatenate([[0], np.cumsum(counts)])
        words = self.symbols(Hasher(data)(starts, ends))
        found: dict[int, list[tuple[int, int, list[str]]]] = {}
        for table in self.tables:
            m = table.length
            for at, window in zip(*table.search(words, docs), strict=True):
                text = table.texts[window]
                # Direct comparison of the words themselves: the symbols came from hashes.
                if all(data[starts[at + k]:ends[at + k]].tobytes() == text[k] for k in range(m)):
                    doc = int(docs[at])
                    found.setdefault(doc, []).append((int(at - begin[doc]), int(at - begin[doc] + m),
                                                      table.items[window]))
        return counts, found


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW,
           block_windows: int = BLOCK_WINDOWS) -> Iterator[Block]:
    """The test strings, a bounded block at a time; at least one block, which may be empty."""
    rows: dict[tuple[bytes, ...], list[str]] = {}
    made = held = 0
    for row in benchmark.select(F.coalesce(col(item_id).cast("string"), F.lit("null")).alias("i"),
                                col(text).alias("t")).toLocalIterator():
        part = next(slices(pa.array([row.t], pa.string())))
        data, starts, ends, _ = words_of(part)
        words = [data[s:e].tobytes() for s, e in zip(starts, ends, strict=True)]
        n = min(window, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            items = rows.setdefault(tuple(words[k:k + n]), [])
            if row.i not in items[-1:]:
                items.append(row.i)
                held += 1
            if held >= block_windows:
                yield Block(rows)
                rows, made, held = {}, made + 1, 0
    if rows or not made:
        yield Block(rows)


def _union(spans: list[int]) -> list[int]:
    """Flat start, end, start, end ... of the union of flat ranges."""
    out: list[int] = []
    for s, e in sorted(zip(spans[::2], spans[1::2], strict=True)):
        if out and s <= out[-1]:
            out[-1] = max(out[-1], e)
        else:
            out += [s, e]
    return out


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
         benchmark_text: str = "text", window: int = WINDOW, block_windows: int = BLOCK_WINDOWS,
         prefix: str = "") -> DataFrame:
    """Add ``n_words``, ``hit_spans`` (flat word ranges inside occurrences, merged) and ``items`` (sorted ids).

    ``prefix`` is put before the three names.
    """
    out = docs
    added = [field(f"{prefix}n_words", "bigint"), field(f"{prefix}hit_spans", "array<bigint>"),
             field(f"{prefix}items", "array<string>")]
    for k, block in enumerate(blocks(benchmark, item_id, benchmark_text, window, block_windows)):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(column: pa.Array, shared=shared, first=k == 0) -> list:
            texts = column if first else column.field(0)
            spans: list[list[int]] = []
            items: list[list[str]] = []
            counts = [np.zeros(0, np.int64)]
            for part in slices(texts):
                n, found = shared.value.occurrences(part)
                counts.append(n)
                for i in range(part.n):
                    hits = found.get(i, ())
                    spans.append(_union([x for s, e, _ in hits for x in (s, e)]))
                    items.append(sorted({x for *_, ids in hits for x in ids}))
            if not first:
                before = column.field(1).to_pylist(), column.field(2).to_pylist()
                spans = [_union(a + b) for a, b in zip(before[0], spans, strict=True)]
                items = [sorted({*a, *b}) for a, b in zip(before[1], items, strict=True)]
            return [np.concatenate(counts), pa.array(spans, pa.list_(pa.int64())),
                    pa.array(items, pa.list_(pa.string()))]

        if k == 0:
            out = with_columns(docs, added, run, text)
        else:
            name = unused(out, "_block")
            packed = out.withColumn(name, F.struct(col(text), *(col(f.name) for f in added[1:])))
            out = with_columns(packed, added, run, name).drop(name)
    return out


def digest(found: DataFrame) -> DataFrame:
    """Counts and the hash of the item ids, for one row per document."""
    spans = F.sequence(F.lit(0), F.expr("cast(size(hit_spans) div 2 as int) - 1"))
    n_hit = F.when(F.size("hit_spans") == 0, F.lit(0).cast("long")).otherwise(
        F.aggregate(spans, F.lit(0).cast("long"),
                    lambda t, k: t + F.get("hit_spans", 2 * k + 1) - F.get("hit_spans", 2 * k)))
    return found.withColumns({
        "n_hit": n_hit, "n_items": F.size("items").cast("long"),
        "items_sha256": F.sha2(F.array_join("items", ",").cast("binary"), 256), "contaminated": n_hit > 0})


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no test window occurs, with their own columns only."""
    prefix = "_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix += "_"
    found = find(docs, benchmark, prefix=prefix, **options)
    return found.filter(F.size(f"{prefix}hit_spans") == 0).select(*map(col, docs.columns))
