"""SimHash near-duplicates: fingerprints linked at few differing bits, found through the anchor points of a covering code.

Anchors are the words of a covering code. Two fingerprints within distance t meet at an anchor: let c be the anchor
nearest to the one that lies closer to its anchor, at distance r; the other is within r + t of c, and its own nearest
anchor is no closer than r. So it is enough to give each fingerprint to all anchors within (its distance to the code)
+ t, which is at most the covering radius + t, and to compare at each anchor.

The code covers 32 bits as a product of perfect codes: binary Golay on 23 bits (radius 3), Hamming on 7 bits (radius 1)
and 2 free bits: 2^18 anchors of covering radius 4. A pair that differs in at most 3 of 64 bits differs in at most 1 bit
of one half, so the two halves are covered with t = 1 each, which keeps the copies per fingerprint at about twenty.

Equal fingerprints are one node from the start. Anchor groups are compared in blocks of bounded size: a group beyond
``GROUP`` members is dealt to block pairs by a hash, so that no task ever holds more than two blocks. A group reports the
links of a spanning forest of its members, not all pairs; components are then joined (see ``components``).

Edge cases: null and empty texts, and texts of spaces only, have fingerprint zero and link like any other; texts of fewer
words than a shingle hash whole; repeated rows and ids share a node; a null id gets a fingerprint and its component,
but never names one (a component of null ids only has a null id); other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.components import components, stored
from strata.llm.frames import col, field, row_hash, unused, with_columns

SHINGLE = 3
DISTANCE = 3
SEED = 42
GROUP = 2048
ROWS = 256  # texts that a worker has in Python at a time
GOLAY = 0b101011100011  # generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
HAMMING = 0b1011


# --- fingerprints ----------------------------------------------------------------------------------------------------

def fingerprint(text: str | None, n: int = SHINGLE) -> int:
    """Bit majority over the XXH64 of all word shingles, as an unsigned 64-bit number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= n:
        return digest(b" ".join(words), SEED)
    shingles = map(b" ".join, zip(*(words[k:] for k in range(n)), strict=False))
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64, len(words) - n + 1)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[k:k + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", output: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """Add the fingerprint as a signed 64-bit column. One map over the documents, no shuffle."""
    def run(column: pa.Array) -> list:
        found = [fingerprint(t, shingle) for k in range(0, len(column), ROWS) for t in column.slice(k, ROWS).to_pylist()]
        return [np.array(found, np.uint64).view(np.int64)]

    return with_columns(docs, [field(output, "bigint")], run, text)


# --- the covering code ------------------------------------------------------------------------------------------------

def _light(width: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """All error patterns of at most ``most`` bits, and their weights."""
    words = np.arange(1 << width, dtype=np.int64)
    weight = np.bitwise_count(words).astype(np.int64)
    return words[weight <= most], weight[weight <= most]


def _remainder(x: np.ndarray, generator: int, width: int) -> np.ndarray:
    """The coset of a word. All words of one coset see the code alike: word ^ pattern is an anchor."""
    degree = generator.bit_length() - 1
    x = x.copy()
    for k in range(width - 1, degree - 1, -1):
        x ^= np.where((x >> k) & 1 == 1, generator << (k - degree), 0)
    return x


class Cover:
    """Patterns that lead from a 32-bit half to all its anchors within (distance to the code) + ``slack``."""

    def __init__(self, slack: int = 1):
        self.slack = slack
        self.golay = self._patterns(GOLAY, 23, 3)
        self.hamming = self._patterns(HAMMING, 7, 1)

    def _patterns(self, generator: int, width: int, radius: int) -> dict[int, list[np.ndarray]]:
        """By coset: error patterns of each weight above the coset's least, up to the slack."""
        light, weight = _light(width, radius + self.slack)
        coset = _remainder(light, generator, width)
        out: dict[int, list[np.ndarray]] = {}
        order = np.lexsort((weight, coset))
        borders = np.flatnonzero(np.diff(coset[order])) + 1
        for part in np.split(order, borders):
            least = weight[part].min()
            out[int(coset[part[0]])] = [light[part[weight[part] == least + k]] for k in range(self.slack + 1)]
        return out

    def anchors(self, halves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, anchor) of all anchors near each 32-bit half."""
        rows, found = [], []
        left, mid, rest = halves & 0x7FFFFF, (halves >> 23) & 0x7F, halves >> 30
        g, h = _remainder(left, GOLAY, 23), _remainder(mid, HAMMING, 7)
        key = g * 256 + h
        order = np.argsort(key, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(key[order])) + 1) if len(order) else ():
            a, b = self.golay[int(g[part[0]])], self.hamming[int(h[part[0]])]
            free = [np.zeros(1, np.int64), np.array([1, 2], np.int64)]
            patterns = [(x | (y << 23) | (z << 30)) for i in range(self.slack + 1) for j in range(self.slack + 1 - i)
                        for k in range(min(2, self.slack + 1 - i - j))
                        for x in [a[i][:, None, None]] for y in [b[j][None, :, None]] for z in [free[k][None, None, :]]]
            flat = np.concatenate([p.ravel() for p in patterns])
            rows.append(np.repeat(part, len(flat)))
            found.append((halves[part][:, None] ^ flat[None, :]).ravel())
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(rows), np.concatenate(found)


# --- links ----------------------------------------------------------------------------------------------------------------

def _forest(values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of ``values`` (distinct, unsigned) under the distance: one search per member."""
    left, a, b = np.ones(len(values), bool), [], []
    for root in range(len(values)):
        if not left[root]:
            continue
        left[root] = False
        todo = [root]
        while todo:
            x = todo.pop()
            rest = np.flatnonzero(left)
            if not len(rest):
                break
            near = rest[np.bitwise_count(values[rest] ^ values[x]) <= distance]
            left[near] = False
            a += [values[x]] * len(near)
            b += list(values[near])
            todo += near.tolist()
    return np.array(a, np.uint64), np.array(b, np.uint64)


def links(nodes: DataFrame, distance: int = DISTANCE, group: int = GROUP) -> DataFrame:
    """``a, b``: links that connect all distinct fingerprints (column ``fp``) within ``distance``, at most 3 bits.

    A link that shows at several anchors is given as often.
    """
    if not 0 <= distance <= 3:
        raise ValueError("the cover by halves holds for 0 to 3 differing bits")
    cover = Cover(distance // 2)

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for k in range(0, len(values), 8192):
                part = values[k:k + 8192]
                for half in (0, 1):
                    rows, anchor = cover.anchors(((part >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)).view(np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(anchor * 2 + half), pa.array(part[rows].view(np.int64))],
                                                     ["anchor", "fp"])

    copies = nodes.select("fp").mapInArrow(replicate, "anchor long, fp long")
    # Alone at an anchor there is nothing to compare: a count that is combined before the shuffle tells.
    sizes = copies.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1")
    met = copies.join(sizes, "anchor")
    # Large groups: blocks by hash, and each member goes to all pairs of its block.
    n_blocks = F.ceil(F.col("n") / group).cast("long")
    block = F.pmod(F.xxhash64("fp"), n_blocks)
    dealt = met.withColumns({"blocks": n_blocks, "block": block}).select(
        "anchor", "fp", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda o: F.struct(
            F.least(o, "block").alias("i"), F.greatest(o, "block").alias("j")))).alias("pair"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = np.zeros((3, 0), np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            keys = np.concatenate([keys, np.stack([batch.column(k).to_numpy() for k in (0, 1, 2)])], axis=1)
            values = np.concatenate([values, batch.column(3).to_numpy().view(np.uint64)])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            if len(cuts):  # the last group may go on in the next batch
                yield _group_links(values[:cuts[-1]], cuts, distance)
                keys, values = keys[:, cuts[-1]:], values[cuts[-1]:]
        if len(values):
            yield _group_links(values, np.array([len(values)]), distance)

    grouped = dealt.select("anchor", "pair.i", "pair.j", "fp")
    sorted_ = grouped.repartition("anchor", "i", "j").sortWithinPartitions("anchor", "i", "j")
    return sorted_.mapInArrow(compare, "a long, b long")


def _group_links(values: np.ndarray, ends: np.ndarray, distance: int) -> pa.RecordBatch:
    """Links of all groups that end at ``ends``. Small groups without any link are passed over in vectorised steps."""
    starts = np.concatenate([[0], ends[:-1]])
    sizes = ends - starts
    of = np.repeat(np.arange(len(ends)), sizes)
    linked = sizes > 64
    small = np.flatnonzero(~linked[of])
    for step in range(1, int(sizes[~linked].max(initial=1))):
        x, y = small[:-step], small[step:]
        same = of[x] == of[y]
        if not same.any():
            break
        x, y = x[same], y[same]
        linked[of[x[np.bitwise_count(values[x] ^ values[y]) <= distance]]] = True
    found = [_forest(np.unique(values[starts[g]:ends[g]]), distance) for g in np.flatnonzero(linked)]
    a, b = (np.concatenate([np.zeros(0, np.uint64), *(x[k] for x in found)]).view(np.int64) for k in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def roots(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``fp, root`` for the distinct fingerprints in column ``fp``: the least fingerprint each can reach by links."""
    found = components(links(nodes, distance)).withColumnsRenamed({"node": "fp"})
    return nodes.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE) -> DataFrame:
    """``docs`` without the text, with ``fingerprint`` (16 hex digits) and ``component_id``: the least id that links
    lead to, the document's own included.

    The text is read once and never shuffled; ids and fingerprints are kept in the shared folder.
    """
    name = unused(docs, "_fp")
    rest = [c for c in docs.columns if c != text and c.lower() not in ("fingerprint", "component_id")]
    marked = stored(fingerprints(docs, text, name, shingle).select(*map(col, [*rest, name])), "fingerprints")
    nodes = stored(marked.groupBy(F.col(name).alias("fp")).agg(F.min(col(doc_id)).alias("least")), "nodes")
    of = roots(nodes, distance)
    least = of.groupBy("root").agg(F.min("least").alias("component_id"))
    found = of.join(least, "root").select(F.col("fp").alias(name), "component_id")
    hexed = F.lower(F.lpad(F.hex(col(name)), 16, "0")).alias("fingerprint")
    return marked.join(found, name).select(*map(col, rest), hexed, F.col("component_id"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             distance: int = DISTANCE) -> DataFrame:
    """One row of each near-duplicate group, with its columns: the least id (nulls last), then the least row hash.

    Groups are settled on ids, fingerprints and row hashes alone. Texts are moved once, to pick the rows to keep; rows
    that agree in every column (maps by their entries as JSON) are one.
    """
    # A row is known by its id and hash; the names are such that no column of the documents has.
    hashed = unused(docs, "_row")
    rows = docs.withColumn(hashed, row_hash(docs))
    marked = fingerprints(rows.select(col(doc_id).alias("id"), col(text).alias("text"), F.col(hashed).alias("row")),
                          output="fp", shingle=shingle)
    marked = stored(marked.select("id", "fp", "row"), "fingerprints")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row"))
    nodes = stored(marked.groupBy("fp").agg(first.alias("first")), "nodes")
    kept = roots(nodes, distance).groupBy("root").agg(F.min("first").alias("first"))
    names = [unused(docs, n) for n in ("_kept_id", "_kept_row")]
    kept = kept.select("first.id", "first.row").toDF(*names)
    same = (F.col(hashed) == F.col(names[1])) & col(doc_id).eqNullSafe(F.col(names[0]))
    return rows.join(kept, same, "left_semi").dropDuplicates([doc_id, hashed]).select(*map(col, docs.columns))
