"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct hashes, in ``2 ** bits`` slots, of its lower-cased words, word pairs and pairs that
skip one word, of the words' first letters (4, 5 and 6, which hold together the forms of one stem), and a slot for the
bias. Learning is online with per-coordinate rates; the L1 term leaves most weights at zero, so that a model is a short
list of slots and weights. It never exceeds ``2 ** bits`` entries of 12 bytes (12 MB by default), the proven bound of
what is broadcast.

The classifier is fitted on a bounded sample: at most about ``sample_rows`` labelled rows (a documented parameter; a
smaller set is used whole). Features are extracted where the rows are. The learning itself is one task over the
sample's feature lists.

Edge cases: a null or empty text has the bias as its only feature; labels that are null are not used; without labelled
rows of both classes every score is the smoothed rate of the labels seen (one half without any); equal texts get equal
scores; rows that agree in id, text and label teach once; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.frames import col, field, unused, with_columns
from strata.llm.text import Hasher, Slice, grams, mix, slices

BITS = 20
SAMPLE_ROWS = 12000
THRESHOLD = 0.3
STEMS = (4, 5, 6)
# Bytes of text that features are made of at a time: a worker holds some hundred times as much in hashes and tables.
SLICE = 1 << 19

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD = np.zeros(256, bool)
WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def features(part: Slice, bits: int = BITS, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Document and slot of each distinct feature, ordered by document and slot. Slot 0 is the bias.

    ``wanted`` marks the slots that matter (scoring has no use for slots of weight zero, which are nearly all); others
    are left out before the distinct ones are found.
    """
    data = LOWER[part.data]
    starts, ends, docs = part.runs(WORD[data])
    hasher = Hasher(data)
    words = hasher(starts, ends)
    # Distinct word forms first: most words of a text are repeats.
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    found = [(docs, words)]
    at_char = np.flatnonzero((data & 0xC0) != 0x80)
    for n in STEMS:
        long = np.flatnonzero(chars[ends] - chars[starts] > n)
        cut = at_char[chars[starts[long]] + n]
        found.append((docs[long], mix(hasher(starts[long], cut) + np.uint64(n))))
    for skip in (0, 1):
        hashes, at = grams(words, docs, 2, skip)
        found.append((docs[at], hashes))
    keys = [np.arange(part.n, dtype=np.uint64) << np.uint64(bits)]
    for of, hashes in found:
        slot = np.maximum(hashes >> np.uint64(64 - bits), np.uint64(1))
        if wanted is not None:
            hit = np.flatnonzero(wanted[slot.view(np.int64)])
            of, slot = of[hit], slot[hit]
        keys.append((of.astype(np.uint64) << np.uint64(bits)) | slot)
    keys = np.unique(np.concatenate(keys))
    return (keys >> np.uint64(bits)).astype(np.int64), (keys & np.uint64((1 << bits) - 1)).astype(np.int64)


@dataclass(frozen=True)
class Rates:
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 2.0
    l2: float = 0.1
    passes: int = 3


@dataclass(frozen=True)
class Model:
    slots: np.ndarray
    weights: np.ndarray
    bits: int = BITS

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.bits, np.float64)
        out[self.slots] = self.weights
        return out


def pack(slots: np.ndarray) -> bytes:
    """Ascending slots as their differences, of two bytes each where all fit."""
    gaps = np.diff(slots, prepend=0)
    small = gaps.max(initial=0) < 1 << 16
    return (b"\2" if small else b"\4") + gaps.astype(np.uint16 if small else np.uint32).tobytes()


def unpack(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(packed, np.uint16 if packed[0] == 2 else np.uint32, offset=1), dtype=np.int64)


class Packed:
    """Feature lists that are unpacked one at a time, each time they are gone through."""

    def __init__(self, lists: list[bytes]):
        self.lists = lists

    def __iter__(self) -> Iterator[np.ndarray]:
        return map(unpack, self.lists)


def ftrl(rows: Iterable[np.ndarray], labels: np.ndarray, bits: int = BITS, rates: Rates = Rates()) -> Model:
    """FTRL-proximal over sparse binary features, in the order given."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    root = lambda x: (rates.beta + np.sqrt(x)) / rates.alpha + rates.l2

    def weights(at):
        return np.where(np.abs(z[at]) <= rates.l1, 0.0, (np.sign(z[at]) * rates.l1 - z[at]) / root(n[at]))

    for _ in range(rates.passes):
        for at, y in zip(rows, labels, strict=True):
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = p - y
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / rates.alpha
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(np.arange(1 << bits))
    slots = np.flatnonzero(w)
    return Model(slots, w[slots], bits)


def fit(labelled: DataFrame, text: str = "text", label: str = "toxic", order: Column | None = None, bits: int = BITS,
        sample_rows: int = SAMPLE_ROWS, rates: Rates = Rates()) -> Model:
    """Learn from a bounded sample of the rows with a label of 0 or 1.

    Rows are sampled and put in order by a hash of ``order`` and the text; rows that agree in both and in the label are
    one, so that no document fills the sample, however often it stands in the table.
    """
    rows = labelled.filter(F.col(label).isin(0, 1)).select(
        F.col(text).alias("text"), F.col(label).cast("int").alias("label"),
        F.xxhash64(*([] if order is None else [order]), F.col(text)).alias("at"))
    total = rows.select("at", "label").distinct().count()
    if total > sample_rows:
        rows = rows.filter(F.pmod("at", F.lit(1 << 30)) < int((1 << 30) * sample_rows / total))

    def extract(column: pa.Array) -> list:
        lists: list[bytes] = []
        for part in slices(column, SLICE):
            docs, slots = features(part, bits)
            lists += map(pack, np.split(slots, np.searchsorted(docs, np.arange(1, part.n))))
        return [pa.array(lists, pa.binary())]

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames = [b.to_pandas() for b in batches]
        seen = pd.concat(frames) if frames else pd.DataFrame({"at": [], "label": [], "slots": []})
        seen = seen.assign(size=seen.slots.map(lambda x: (len(x) - 1) // x[0])).sort_values(["at", "size", "label"])
        y = seen.label.to_numpy(float)
        if len(set(y)) < 2:
            rate = (y.sum() + 1) / (len(y) + 2)
            model = Model(np.array([0]), np.array([np.log(rate / (1 - rate))]), bits)
        else:
            model = ftrl(Packed(list(seen.slots)), y, bits, rates)
        yield pa.RecordBatch.from_arrays([pa.array(model.slots.astype(np.int64)), pa.array(model.weights)],
                                         ["slot", "weight"])

    rows = rows.dropDuplicates(["at", "label"])
    lists = with_columns(rows, [field("slots", "binary")], extract, keep_text=False).select("at", "label", "slots")
    found = lists.repartition(1).mapInArrow(learn, "slot long, weight double").toPandas()
    return Model(found.slot.to_numpy(np.int64), found.weight.to_numpy(float), bits)


def score(docs: DataFrame, model: Model, text: str = "text", output: str = "score", keep_text: bool = True) -> DataFrame:
    """Add ``output``: the probability, 0 to 1, that the text is toxic. One map over the documents."""
    shared = docs.sparkSession.sparkContext.broadcast((model.slots, model.weights, model.bits))
    cache: dict[str, np.ndarray] = {}

    def run(column: pa.Array) -> list:
        if "w" not in cache:
            cache["w"] = Model(*shared.value).dense()
            cache["wanted"] = cache["w"] != 0
        found = [np.zeros(0)]
        for part in slices(column, SLICE):
            of, slots = features(part, shared.value[2], cache["wanted"])
            sums = np.bincount(of, cache["w"][slots], minlength=part.n)
            found.append(1 / (1 + np.exp(-np.clip(sums, -35, 35))))
        return [np.concatenate(found)]

    return with_columns(docs, [field(output, "double")], run, text, keep_text)


def held_out(doc_id: Column) -> Column:
    """The quarter of ids kept from learning: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train_on_labels(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, **options) -> Model:
    """Fit on documents with a ``toxic`` label outside the held-out quarter.

    The sample is drawn from the labels, so that at most about ``sample_rows`` ids are broadcast and no text is moved.
    """
    known = labels.select("doc_id", "toxic").filter(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).distinct()
    total = known.count()
    if total > sample_rows:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * sample_rows / total))
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    return fit(rows, order=F.col("doc_id"), sample_rows=sample_rows, **options)


def filter_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score stays below the threshold, with their own columns only."""
    name = unused(docs, "_score")
    return score(docs, model, output=name).filter(F.col(name) < threshold).select(*map(col, docs.columns))
