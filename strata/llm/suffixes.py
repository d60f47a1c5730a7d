"""Removal of long byte strings that occur more than once in a collection, by column-wise suffix ordering.

A byte is removed if a string of ``LENGTH`` bytes that covers it starts at another place too, in the same document or
another. In the order of all suffixes, a string occurs twice exactly if its suffix shares ``LENGTH`` bytes with a
neighbour, so the order and the common prefixes of neighbours are what is needed.

**Cutting the collection.** Each ``LENGTH``-byte string is named by an anchor: the least-hashed ``GRAM``-byte piece
inside it, leftmost among equals. Equal strings have equal anchors at equal places. A run of consecutive starts with one
anchor is a *piece*. Anchors seen once cannot lie in a repeat and go. Equal pieces become one with a count. What is left
with the same anchor is a collection of short documents, aligned at the anchor.

**Column-wise construction.** A batch of collections is built at once, from the last column to the first. Each round
inserts one symbol per document in front of what it has: the order of the new suffixes is that of the last round, dealt
out stably by the new symbol (the step by which a Burrows-Wheeler transform is extended), and the common prefix of two
new neighbours is one more than the least common prefix between their places in the last round, or none if their
symbols differ. Only suffixes of one column can share a string named by the same anchor, so each round keeps one column
of the transform. Each round's order, transform symbols and common prefixes are appended to an external file; a second,
sequential pass over the file marks the repeats. The file is anonymous and lives as long as the batch.

**Large collections.** An anchor with more than ``GROUP`` different pieces is split: starts are dealt to blocks of
columns, and pieces part by the bytes that all strings of a block share. Blocks become narrower level by level, down to
single starts, where equal means identical; every level collapses equal pieces before it shuffles. So no task gets an
unbounded collection, and nothing is dropped.

Documents are known by a 128-bit hash of their text, so ids may be null or repeated.

Edge cases: a null text counts as empty; texts shorter than ``LENGTH`` keep all bytes but can't be matched; repeated
rows are places like any other, so copies of ``LENGTH`` bytes or more lose all; other columns pass through, an output
column replaces one of the same name; an empty table stays empty.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.components import stored
from strata.llm.frames import col, field, unused, with_columns
from strata.llm.text import Hasher, mix, slices

LENGTH = 200
GRAM = 32
GROUP = 4096
BATCH = 8192


# --- pieces -------------------------------------------------------------------------------------------------------------

def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values (blocks with running minima from both ends)."""
    count = len(values) - width + 1
    if count <= 0:
        return values[:0]
    rows = -(-len(values) // width)
    padded = np.full(rows * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:len(values)] = values
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1:width - 1 + count])


def pieces_of(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Document, first start (in it), number of starts, anchor's distance, anchor hash and content hash of each piece."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    hasher = Hasher(data)
    at = np.arange(len(data) - gram + 1)
    grams = hasher(at, at + gram)
    keys = (grams & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    anchor = (sliding_least(keys, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # Starts whose string ends within their document.
    depth = np.zeros(len(anchor) + 1, np.int64)
    long = np.flatnonzero(np.diff(offsets) >= length)
    np.add.at(depth, offsets[long], 1)
    np.add.at(depth, np.minimum(offsets[long + 1] - length + 1, len(anchor)), -1)
    inside = np.cumsum(depth[:-1]) > 0
    new = inside.copy()
    new[1:] &= ~inside[:-1] | (anchor[1:] != anchor[:-1])
    first = np.flatnonzero(new)
    over = np.flatnonzero(~inside)
    after = np.concatenate([first[1:], [len(anchor)]])
    if len(over):  # a piece ends where the next begins or valid starts end
        stop = np.searchsorted(over, first)
        after = np.minimum(after, np.where(stop < len(over), over[np.minimum(stop, len(over) - 1)], len(anchor)))
    docs = np.searchsorted(offsets, first, "right") - 1
    count = after - first
    content = Hasher(data, 2)(first, after - 1 + length)
    return docs, first - offsets[docs], count, anchor[first] - first, grams[anchor[first]], content


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    value = F.coalesce(col(text), F.lit(""))
    return docs.select(F.xxhash64(value).alias("k1"), F.xxhash64(F.lit(7), value).alias("k2"), value.alias("text"))


def piece_table(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``k1, k2`` (text), ``start, count, off`` (place), ``h`` (anchor), ``ph`` (content), one row per piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for part in slices(batch.column(2)):
                of, start, count, off, h, ph = pieces_of(part.data, part.offsets, length, gram)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1[part.first + of]), pa.array(k2[part.first + of]), pa.array(start),
                     pa.array(count.astype(np.int32)), pa.array(off.astype(np.int32)), pa.array(h.view(np.int64)),
                     pa.array(ph.view(np.int64))], ["k1", "k2", "start", "count", "off", "h", "ph"])

    rows = _keyed(docs, text).filter(F.octet_length("text") >= length)
    return rows.mapInArrow(run, "k1 long, k2 long, start long, count int, off int, h long, ph long")


# --- column-wise construction --------------------------------------------------------------------------------------------

def repeats(texts: list[bytes], offs: np.ndarray, counts: np.ndarray, times: np.ndarray, length: int = LENGTH
            ) -> np.ndarray:
    """Which starts of each aligned document occur elsewhere: a table of (document, start), false beyond its starts.

    ``offs``: the column of the anchor in each document; ``times``: how often the document stands in the collection.
    """
    m = len(texts)
    lead = int(offs.max())
    begin = lead - offs                                            # first column of each document
    sizes = np.array([len(t) for t in texts])
    end = begin + sizes
    width = int(end.max())
    table = np.zeros((width, m), np.uint8)                         # one row per column of symbols
    flat = np.frombuffer(b"".join(texts), np.uint8)
    doc = np.repeat(np.arange(m), sizes)
    table[np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + begin[doc], doc] = flat
    marks = np.zeros((m, int(counts.max())), bool)
    marks[(times > 1)[:, None] & (np.arange(marks.shape[1])[None, :] < counts[:, None])] = True
    by_end = np.argsort(-end, kind="stable")
    ends = -end[by_end]
    order, common = np.zeros(0, np.int32), np.zeros(0, np.int16)
    last_start = int((begin + counts).max())                       # columns from here on hold no start
    with tempfile.TemporaryFile() as file:
        rounds = []
        for column in range(width - 1, int(begin.min()) - 1, -1):
            # Documents whose last symbol this is come in front (the end sorts before all symbols); those that began
            # in the column before are complete and leave.
            new = by_end[np.searchsorted(ends, -(column + 1)):np.searchsorted(ends, -(column + 1), "right")]
            order = np.concatenate([new.astype(np.int32), order])
            common = np.concatenate([np.zeros(len(new), np.int16), common])
            going = begin[order] <= column
            symbols = table[column, order]
            places = np.flatnonzero(going)
            dealt = places[np.argsort(symbols[places], kind="stable")]
            least = _least_between(common, dealt[:-1], dealt[1:])
            same = symbols[dealt[1:]] == symbols[dealt[:-1]]
            order = order[dealt]
            common = np.zeros(len(order), np.int16)
            common[1:][same] = np.minimum(least[same] + 1, length)
            if column < last_start:
                before = table[column - 1, order] if column else np.zeros(len(order), np.uint8)
                file.write(order.tobytes() + common.tobytes() + before.tobytes())
                rounds.append((column, len(order)))
        file.seek(0)
        for column, n in rounds:
            order, common = np.frombuffer(file.read(4 * n), np.int32), np.frombuffer(file.read(2 * n), np.int16)
            file.read(n)
            hit = common >= length
            hit[:-1] |= hit[1:]
            found = order[hit]
            start = column - begin[found]
            inside = start < counts[found]
            marks[found[inside], start[inside]] = True
    return marks


def _least_between(values: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """min(values[left + 1 .. right]) for each pair where left < right, by a table of minima over powers of two."""
    if not len(left):
        return np.zeros(0, np.int16)
    span = np.maximum(right - left, 1)
    level = np.frexp(span.astype(np.float64))[1] - 1
    out = np.zeros(len(left), np.int16)
    table, size = values, 1
    for k in range(int(level.max()) + 1):
        at = np.flatnonzero((level == k) & (right > left))
        if len(at):
            out[at] = np.minimum(table[left[at] + 1], table[right[at] - size + 1])
        if 2 * size > len(values):
            break
        table, size = np.minimum(table[:-size], table[size:]), 2 * size
    return out


def ranges(marked: np.ndarray) -> np.ndarray:
    """Flat from, to (exclusive) of the runs of marked positions."""
    return np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))


def _column_wise(pieces: DataFrame, length: int) -> DataFrame:
    """``h, ph, marks``: ranges of repeated starts, from all pieces of each anchor (at most GROUP of them)."""
    def build(rows: list[tuple]) -> pa.RecordBatch:
        h, ph, n, off, count, texts = zip(*rows, strict=True)
        marks = repeats(list(texts), np.array(off), np.array(count), np.array(n), length)
        some = np.flatnonzero(marks.any(axis=1))
        return pa.RecordBatch.from_arrays(
            [pa.array([h[k] for k in some], pa.int64()), pa.array([ph[k] for k in some], pa.int64()),
             pa.array([ranges(marks[k]) for k in some], pa.list_(pa.int64()))], ["h", "ph", "marks"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        border = 0                                                 # where the last, perhaps unfinished, anchor begins
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and row[:2] == held[-1][:2]:
                    continue                                       # the same piece from a copy of its document
                if held and row[0] != held[-1][0]:
                    border = len(held)
                    if border >= BATCH:
                        yield build(held)
                        held, border = [], 0
                held.append(row)
        if held:
            yield build(held)

    rows = pieces.select("h", "ph", "n", "off", "count", "bytes").repartition("h").sortWithinPartitions("h", "ph")
    return rows.mapInArrow(run, "h long, ph long, marks array<long>")


def _split(pieces: DataFrame, width: int, length: int) -> DataFrame:
    """Cut pieces at multiples of ``width`` columns; the bytes that all strings of a block share name the new anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for h, ph, n, off, count, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = np.frombuffer(text, np.uint8)
                block = np.arange(-off // width, (count - 1 - off) // width + 1)     # columns count from the anchor
                first = np.maximum(block * width + off, 0)
                stop = np.minimum((block + 1) * width + off, count)
                # Any string that starts in the block has all of its core, so each piece with such a start has it.
                core = Hasher(data, 3)((block + 1) * width - 1 + off, block * width + off + length)
                content = Hasher(data, 4)(first, stop - 1 + length).view(np.int64)
                with np.errstate(over="ignore"):
                    name = mix(core ^ mix(np.uint64(h % (1 << 64)) ^ mix(block.astype(np.uint64)))).view(np.int64)
                out += [(h, ph, int(s), int(x), int(c), n, int(off - s), int(e - s), text[s:e - 1 + length])
                        for s, e, x, c in zip(first, stop, name, content, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [[]] * 9,
                                                [pa.int64()] * 6 + [pa.int32()] * 2 + [pa.binary()], strict=True)],
                ["h", "ph", "delta", "h2", "ph2", "n", "off", "count", "bytes"])

    return pieces.select("h", "ph", "n", "off", "count", "bytes").mapInArrow(
        run, "h long, ph long, delta long, h2 long, ph2 long, n long, off int, count int, bytes binary")


def widths(length: int, gram: int) -> list[int]:
    """Block widths of the levels, down to single starts."""
    out = [length - gram + 1]
    while out[-1] > 1:
        out.append(max(1, out[-1] // 3))
    return out[1:]


def _all_starts(pieces: DataFrame) -> DataFrame:
    return pieces.select("h", "ph", F.array(F.lit(0).cast("long"), F.col("count").cast("long")).alias("marks"))


def resolve(pieces: DataFrame, length: int, levels: list[int], group: int) -> DataFrame:
    """``h, ph, marks`` from all different pieces ``h, ph, n, off, count, bytes, m`` (m: pieces of the anchor)."""
    found = _column_wise(pieces.filter(F.col("m") <= group), length)
    large = pieces.filter(F.col("m") > group)
    if not levels or large.isEmpty():
        return found
    sub = stored(_split(large, levels[0], length), "split")
    different = sub.groupBy("h2", "ph2").agg(F.sum("n").alias("n"), F.first("off").alias("off"),
                                             F.first("count").alias("count"), F.first("bytes").alias("bytes"))
    different = different.withColumnsRenamed({"h2": "h", "ph2": "ph"})
    known = stored(different.groupBy("h").agg(F.count("*").alias("m")), "anchors")
    different = stored(different.join(known, "h"), "split")
    single = _all_starts(different.filter("m = 1 AND n > 1"))
    deeper = resolve(different.filter("m > 1"), length, levels[1:], group)
    names = sub.select("h", "ph", "delta", "h2", "ph2")
    below = single.union(deeper).withColumnsRenamed({"h": "h2", "ph": "ph2"}).join(names, ["h2", "ph2"])
    return found.union(below.select("h", "ph", F.transform("marks", lambda x: x + F.col("delta")).alias("marks")))


def repeated_starts(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM, group: int = GROUP
                    ) -> DataFrame:
    """``k1, k2, starts``: per different text, flat ranges (perhaps overlapping) of starts of repeated strings."""
    pieces = stored(piece_table(docs, text, length, gram), "pieces")
    # Counts are stored before they are joined: then both sides of the join are plain exchanges, and a hot anchor splits.
    again = stored(pieces.groupBy("h").agg(F.count("*").alias("c")).filter("c > 1").select("h"), "anchors")
    pieces = stored(pieces.join(again, "h", "left_semi"), "again")
    place = F.struct("k1", "k2", "start", "off", "count")
    different = pieces.groupBy("h", "ph").agg(F.count("*").alias("n"), F.min(place).alias("at"))
    different = stored(different.select("h", "ph", "n", "at.*"), "different")
    known = stored(different.groupBy("h").agg(F.count("*").alias("m")), "anchors")
    different = different.join(known, "h")
    single = _all_starts(different.filter("m = 1"))
    # Bytes of one place per piece, where pieces of one anchor differ.
    wanted = different.filter("m > 1").groupBy("k1", "k2").agg(
        F.collect_list(F.struct("h", "ph", "n", "off", "count", "start", "m")).alias("pieces"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, value in enumerate(batch.column(0)):
                data = value.as_py().encode()
                rows = batch.column(1)[k].as_py()
                columns = [pa.array([r[c] for r in rows], kind) for c, kind in (
                    ("h", pa.int64()), ("ph", pa.int64()), ("n", pa.int64()), ("off", pa.int32()),
                    ("count", pa.int32()), ("m", pa.int64()))]
                columns.append(pa.array([data[r["start"]:r["start"] + r["count"] - 1 + length] for r in rows]))
                yield pa.RecordBatch.from_arrays(columns, ["h", "ph", "n", "off", "count", "m", "bytes"])

    # Copies of a text are one before they meet their pieces, already where they are read.
    texts = _keyed(docs, text).groupBy("k1", "k2").agg(F.first("text").alias("text"))
    texts = texts.join(wanted, ["k1", "k2"]).select("text", "pieces")
    collections = texts.mapInArrow(cut, "h long, ph long, n long, off int, count int, m long, bytes binary")
    if not different.filter(F.col("m") > group).isEmpty():
        collections = stored(collections, "collections")
    marks = single.union(resolve(collections, length, widths(length, gram), group))
    at = pieces.join(marks, ["h", "ph"]).select(
        "k1", "k2", F.transform("marks", lambda x: x + F.col("start")).alias("starts"))
    return at.groupBy("k1", "k2").agg(F.flatten(F.collect_set("starts")).alias("starts"))


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM, group: int = GROUP
                   ) -> DataFrame:
    """Add ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``: the bytes left when repeated strings are cut out."""
    found = repeated_starts(docs, text, length, gram, group)
    value = F.coalesce(col(text), F.lit(""))
    # Names that no column of the documents has.
    k1, k2, f1, f2, starts, packed_name = (unused(docs, n) for n in ("_k1", "_k2", "_f1", "_f2", "_starts", "_packed"))
    rows = docs.withColumns({k1: F.xxhash64(value), k2: F.xxhash64(F.lit(7), value)})
    found = found.select(F.col("k1").alias(f1), F.col("k2").alias(f2), F.col("starts").alias(starts))
    rows = rows.join(found, (F.col(k1) == F.col(f1)) & (F.col(k2) == F.col(f2)), "left")
    packed = rows.select(*map(col, docs.columns), F.struct(
        value.alias("text"), F.col(starts).alias("starts")).alias(packed_name))

    def cut(column: pa.Array) -> list:
        size, gone, spans, kept = [], [], [], []
        for value, starts in zip(column.field(0), column.field(1), strict=True):
            data = value.as_py().encode()
            flat = starts.values.to_numpy() if starts.is_valid else np.zeros(0, np.int64)
            depth = np.zeros(len(data) + 1, np.int64)
            np.add.at(depth, flat[::2], 1)
            np.add.at(depth, flat[1::2] - 1 + length, -1)
            runs = ranges(np.cumsum(depth[:-1]) > 0) if len(flat) else flat
            size.append(len(data))
            gone.append(int((runs[1::2] - runs[::2]).sum()))
            spans.append(len(runs) // 2)
            edges = [0, *runs.tolist(), len(data)]
            kept.append(b"".join(data[s:e] for s, e in zip(edges[::2], edges[1::2], strict=True)))
        return [size, gone, spans, pa.array(kept, pa.binary())]

    added = [*(field(c, "bigint") for c in ("n_bytes", "n_removed", "n_spans")), field("kept", "binary")]
    return with_columns(packed, added, cut, packed_name).drop(packed_name)
