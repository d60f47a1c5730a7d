"""Spelling variants: words one edit apart, found by blocked Gram matrices of letter counts.

A word's letter-count vector x has one count per character. One replaced letter changes it by squared distance 2, one
inserted or deleted letter by 1; so the pairs at squared distance 2 at most, of equal or adjacent lengths, hold all words
one edit apart. The squared distances of two blocks of words are |x|^2 + |y|^2 - 2 xy, one matrix product in NumPy, and
the pairs that are close enough are compared letter by letter.

Blocks are the words of one length with the same counts in each of a few fixed classes of letters. An edit moves at most
one letter out of a class and one into a class, so a word meets its own block and those that differ from it by such a
step, and no others. Large blocks are cut by hash into tiles of at most about ``TILE`` words (fewer for long words), and a
task multiplies one pair of tiles at a time. Nothing is collected; a pair of words meets in one pair of tiles only.

Every word points to its form: the most frequent word one edit away, if that is at least twice as frequent. Following
forms at least doubles the count at each step, so the chain ends; it is walked by doubling.

Edge cases: null and empty texts have no words; a null id counts as an empty one; words are told apart by their
characters (case but for A-Z included); equal rows count as often as they stand; an empty table gives an empty result;
columns other than the id and the text are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.components import stored
from strata.llm.frames import col

MIN_CHARS, MIN_COUNT, RATIO, TYPO = 5, 3, 2, 97
TILE = 2048
TILE_CELLS = 1 << 22
HELD = 1 << 18

# Latin-1 bytes of a text: A-Z lower-cased, what stands between words made blank.
LETTERS = [*range(0x61, 0x7B), *range(0xC0, 0x100)]
RUNS = bytes(c + 32 if 0x41 <= c < 0x5B else c if c in LETTERS else 0x20 for c in range(256))

# Classes of letters by code point, and numbers for them by which a block's counts become one number (two blocks with one
# number would only be compared as well). The products of 31-bit counts and their sum stay within 64 bits.
CLASSES = ["".join(chr(c) for c in LETTERS if c % 5 == k) for k in range(5)]
PRIME = 536870909
NUMBERS = [pow(7919, 3 * k + 2, PRIME) for k in range(5)]


# --- words ------------------------------------------------------------------------------------------------------------

def tally(texts: list[str | None], ids: list, min_chars: int = MIN_CHARS, typo: int = TYPO) -> dict[bytes, int]:
    """How often each word, as Latin-1 bytes, stands in the texts. In 1/``typo`` of the (id, word) pairs one letter is
    left out."""
    seen: dict[bytes, int] = {}
    for doc_id, text in zip(ids, texts, strict=True):
        name = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
        # Characters beyond Latin-1 are no letters here; each becomes one "?".
        for word, n in Counter((text or "").encode("latin-1", "replace").translate(RUNS).split()).items():
            if len(word) < min_chars:
                continue
            h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), name)
            if h % typo == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1:]
                if len(word) < min_chars:
                    continue
            seen[word] = seen.get(word, 0) + n
    return seen


def words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
          min_count: int = MIN_COUNT, typo: int = TYPO) -> DataFrame:
    """``word, n`` of all words that are long and frequent enough. Tasks add up before anything is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in seen], pa.string()),
                                              pa.array(seen.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                ids, texts = (batch.column(j).slice(k, 256).to_pylist() for j in (0, 1))
                seen.update(tally(texts, ids, min_chars, typo))
                if len(seen) > HELD:
                    yield out()
                    seen.clear()
        yield out()

    found = docs.select(col(doc_id).cast("string").alias("id"), col(text).alias("text")).mapInArrow(
        run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


# --- near words -------------------------------------------------------------------------------------------------------

def _block(word: Column) -> Column:
    """The number of a word's counts per class of letters."""
    counts = [F.length(word) - F.length(F.translate(word, letters, "")) for letters in CLASSES]
    return sum((c.cast("long") * n for c, n in zip(counts, NUMBERS, strict=True)), F.lit(0)) % PRIME


def _steps() -> list[tuple[int, int]]:
    """Changes of a block's number that one edit can make, up to its direction, and letters more: none, one, one moved."""
    moved = [((NUMBERS[i] - NUMBERS[j]) % PRIME, 0) for i in range(len(CLASSES)) for j in range(i)]
    return [(0, 0), *((n, 1) for n in NUMBERS), *moved]


def _codes(some: np.ndarray) -> np.ndarray:
    """Code points of words of one length."""
    return np.frombuffer("".join(some).encode("latin-1"), np.uint8).reshape(len(some), -1)


def _counts(sides: list[np.ndarray], dtype: type) -> list[np.ndarray]:
    """Letter counts of the words of each side, with a column for every letter that occurs."""
    used = np.zeros(256, bool)
    for codes in sides:
        used[codes] = True
    column, width = np.cumsum(used) - 1, int(used.sum())
    return [np.bincount((column[codes] + np.arange(len(codes))[:, None] * width).ravel(), minlength=len(codes) * width)
            .reshape(len(codes), width).astype(dtype) for codes in sides]


def one_edit(short: np.ndarray, long: np.ndarray, same_length: bool) -> np.ndarray:
    """Which rows of code points differ by one replaced letter, or (``long`` has one more) by one inserted letter."""
    if same_length:
        return (short != long).sum(axis=1) == 1
    width = short.shape[1]
    head = np.cumprod(short == long[:, :width], axis=1).sum(axis=1)
    tail = np.cumprod((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= width


def near_pairs(left: np.ndarray, right: np.ndarray, same_tile: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of words one edit apart. All words of a side have one length, equal or one more on the right."""
    if not len(left) or not len(right):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a = _codes(left)
    b = a if same_tile else _codes(right)
    short, long = a.shape[1], b.shape[1]
    # Products of counts are exact in single precision below 2^24.
    x, *rest = _counts([a] if same_tile else [a, b], np.float32 if long < 2048 else np.float64)
    y = rest[0] if rest else x
    gram = x @ y.T
    gap = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * gram
    i, j = np.nonzero(gap <= 2)
    if same_tile:
        i, j = i[i < j], j[i < j]
    step = max(1, TILE_CELLS // long)
    near = [one_edit(a[i[k:k + step]], b[j[k:k + step]], short == long) for k in range(0, len(i), step)]
    kept = np.concatenate(near) if near else np.zeros(0, bool)
    return i[kept], j[kept]


def neighbours(vocabulary: DataFrame, tile: int = TILE) -> DataFrame:
    """``word, n, other, other_n``: every ordered pair of words that are one edit apart. Takes ``word, n``."""
    keyed = vocabulary.select("word", "n", F.length("word").alias("length"), _block(F.col("word")).alias("block"))
    per_tile = F.greatest(F.lit(1), F.least(F.lit(tile), F.lit(TILE_CELLS) / F.col("length"))).cast("long")
    sizes = stored(keyed.groupBy("length", "block").agg(F.count("*").alias("size")).select(
        "length", "block", F.ceil(F.col("size") / per_tile).cast("long").alias("tiles")), "blocks")
    keyed = keyed.join(sizes, ["length", "block"]).withColumn("tile", F.pmod(F.xxhash64("word"), F.col("tiles")))
    # A pair of blocks is named by its lower block and the step to the upper one. A word is the left side where its own
    # block is the lower one, and goes to every pair whose other block has words, once for each tile of that block.
    steps = [F.struct(F.lit(k).alias("step"), F.lit(side).alias("side"), F.lit(n).cast("long").alias("number"),
                      F.lit(longer).alias("longer"))
             for k, (n, longer) in enumerate(_steps()) for side in (0, 1) if k or not side]
    each = keyed.select("*", F.inline(F.array(*steps)))
    sign = F.when(F.col("side") == 0, 1).otherwise(-1)
    met = each.withColumns({"to_length": F.col("length") + sign * F.col("longer"),
                            "to_block": F.pmod(F.col("block") + sign * F.col("number"), F.lit(PRIME))})
    met = met.join(sizes.toDF("to_length", "to_block", "others"), ["to_length", "to_block"])
    copies = met.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1)).alias("other"))
    left = F.when(F.col("step") == 0, F.col("tile") <= F.col("other")).otherwise(F.col("side") == 0)
    dealt = copies.select(
        F.when(F.col("side") == 0, F.col("length")).otherwise(F.col("to_length")).alias("length"),
        F.when(F.col("side") == 0, F.col("block")).otherwise(F.col("to_block")).alias("block"), "step",
        F.when(left, F.col("tile")).otherwise(F.col("other")).alias("i"),
        F.when(left, F.col("other")).otherwise(F.col("tile")).alias("j"), left.alias("left"), "word", "n")
    keys = ["length", "block", "step", "i", "j"]
    ordered = dealt.repartition(*keys).sortWithinPartitions(*keys)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # of the pair of tiles that is being read
        last = None
        for batch in batches:
            pair = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(5)])
            cuts = [0, *(np.flatnonzero((pair[:, 1:] != pair[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if held and (pair[:, a] != last).any():
                    yield from _products(held, inner=last[2] == 0 and last[3] == last[4])
                    held = []
                held.append(batch.slice(a, b - a))
                last = pair[:, a]
        if held:
            yield from _products(held, inner=last[2] == 0 and last[3] == last[4])

    return ordered.mapInArrow(multiply, "word string, n long, other string, other_n long")


def _products(rows: list[pa.RecordBatch], inner: bool) -> Iterator[pa.RecordBatch]:
    left, word, n = (np.concatenate([r.column(k).to_numpy(zero_copy_only=False) for r in rows]) for k in (5, 6, 7))
    right = np.flatnonzero(left if inner else ~left)
    left = np.flatnonzero(left)
    i, j = near_pairs(word[left], word[right], inner)
    if len(i):
        i, j = left[i], right[j]
        a, b = np.concatenate([i, j]), np.concatenate([j, i])
        yield pa.RecordBatch.from_arrays([pa.array(word[a], pa.string()), pa.array(n[a]), pa.array(word[b], pa.string()),
                                          pa.array(n[b])], ["word", "n", "other", "other_n"])


# --- forms ------------------------------------------------------------------------------------------------------------

def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for every word of ``word, form``: the end of its chain of forms. Doubles the steps each round."""
    at = stored(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = stored(at.join(further, "root").select("word", F.col("next").alias("root"), F.col("root").alias("was")),
                       "roots")
        if after.filter("root != was").isEmpty():
            return after.select("word", "root")
        at = after.select("word", "root")


def group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ratio: int = RATIO, tile: int = TILE,
          **options) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word (see :func:`words` for the options)."""
    vocabulary = stored(words(docs, doc_id, text, **options), "vocabulary")
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word")))
    found = neighbours(vocabulary, tile).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = vocabulary.join(found, "word", "left")
    strong = -F.col("best.n") >= ratio * F.col("n")
    formed = stored(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                  F.when(strong, F.col("best.word")).alias("form"),
                                  F.when(strong, -F.col("best.n")).cast("long").alias("form_n")), "forms")
    return formed.join(roots(formed), "word").select("word", "form", "root", "n", "n_near", "form_n")
