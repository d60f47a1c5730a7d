"""Quality rules as a short-circuit cascade ordered by rejection per cost.

A rule is a name, a measure and a bound on it. The cost (seconds a document) and the selectivity (share rejected) of
each rule are estimated in a Spark job over a bounded random sample; the rules then run in order of rejection per
cost, each only on the documents that all earlier rules kept. The verdict does not depend on the order.

Edge cases: a null or empty text has no words and fails ``min_words``; equal rows get equal results; other columns pass
through untouched, and an output column replaces an input column of the same name; an empty table gives an empty
result.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.frames import field, with_columns
from strata.llm.text import SPACE, Hasher, Slice, covered, grams, mix, repeated, slices

COUNTS = ("n_words", "word_chars", "n_symbols", "n_upper", "n_exclaims", "n_lines", "n_dup_lines", "n_repeat_words")
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


class Measures:
    """The measures of one slice's documents, each computed when first asked for."""

    def __init__(self, whole: Slice, rows: np.ndarray | None = None):
        self._whole, self._rows = whole, rows
        self.n = whole.n if rows is None else len(rows)

    @cached_property
    def part(self) -> Slice:
        return self._whole if self._rows is None else self._whole.take(self._rows)

    def narrowed(self, keep: np.ndarray) -> Measures:
        """The same for fewer documents: known counts are cut, others are computed for the rest only."""
        rows = np.flatnonzero(keep) if self._rows is None else self._rows[keep]
        out = Measures(self._whole, rows)
        out.__dict__ |= {k: v[keep] for k, v in self.__dict__.items() if k in COUNTS}
        return out

    @cached_property
    def _words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.part.runs(~SPACE[self.part.data])

    @cached_property
    def n_words(self) -> np.ndarray:
        return np.bincount(self._words[2], minlength=self.part.n)

    @cached_property
    def word_chars(self) -> np.ndarray:
        data = self.part.data
        return self.part.per_doc(~SPACE[data] & ((data & 0xC0) != 0x80))

    @cached_property
    def n_symbols(self) -> np.ndarray:
        return self.part.per_doc(SYMBOLS[self.part.data])

    @cached_property
    def n_upper(self) -> np.ndarray:
        return self.part.per_doc((self.part.data >= 65) & (self.part.data <= 90))

    @cached_property
    def n_exclaims(self) -> np.ndarray:
        return self.part.per_doc(self.part.data == 33)

    @cached_property
    def _lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Document and hash of each line that holds a word."""
        starts, ends, docs = self.part.runs(self.part.data != 10)
        words = np.concatenate([[0], np.cumsum(~SPACE[self.part.data])])
        worded = words[ends] > words[starts]
        starts, ends, docs = starts[worded], ends[worded], docs[worded]
        return docs, Hasher(self.part.data)(starts, ends)

    @cached_property
    def n_lines(self) -> np.ndarray:
        return np.bincount(self._lines[0], minlength=self.part.n)

    @cached_property
    def n_dup_lines(self) -> np.ndarray:
        docs, hashes = self._lines
        _, first = np.unique(mix(hashes ^ mix(docs.astype(np.uint64) + np.uint64(1))), return_index=True)
        return self.n_lines - np.bincount(docs[first], minlength=self.part.n)

    @cached_property
    def n_repeat_words(self) -> np.ndarray:
        starts, ends, docs = self._words
        hashes, at = grams(Hasher(self.part.data)(starts, ends), docs, 3)
        twice = repeated(mix(hashes ^ mix(docs[at].astype(np.uint64) + np.uint64(1))))
        hit = covered(at[twice], 3, len(docs))
        return np.bincount(docs[hit], minlength=self.part.n)


@dataclass(frozen=True)
class Rule:
    """``fails`` gets the measures and says which documents the rule rejects."""

    name: str
    fails: Callable[[Measures], np.ndarray]


# Percentages as integers, so that a SQL statement of the rules agrees to the last document.
BASE = (
    Rule("min_words", lambda m: m.n_words < 50),
    Rule("repeated_words", lambda m: 100 * m.n_repeat_words > 50 * m.n_words),
)
RULES = (
    *BASE,
    Rule("symbols", lambda m: 100 * m.n_symbols > 10 * m.n_words),
    Rule("word_length", lambda m: (m.word_chars < 2 * m.n_words) | (m.word_chars > 15 * m.n_words)),
    Rule("duplicate_lines", lambda m: 100 * m.n_dup_lines > 30 * m.n_lines),
    Rule("upper_case", lambda m: 100 * m.n_upper > 50 * m.word_chars),
    Rule("exclaims", lambda m: 100 * m.n_exclaims > 30 * m.n_words),
)

SAMPLE_ROWS = 2000


def estimate(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text",
             sample_rows: int = SAMPLE_ROWS) -> dict[str, tuple[float, float]]:
    """Cost (seconds a document) and selectivity (share rejected) of each rule on about ``sample_rows`` random rows.

    Rules are timed alone, each with measures of its own. Only one row per rule comes to the driver.
    """
    total = docs.count()
    if not total:
        return {r.name: (1.0, 0.0) for r in rules}
    schema = T.StructType([T.StructField("rule", T.StringType()), T.StructField("seconds", T.DoubleType()),
                           T.StructField("rejected", T.LongType()), T.StructField("rows", T.LongType())])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for part in slices(batch.column(0)):
                for rule in rules:
                    began = time.thread_time()
                    rejected = int(rule.fails(Measures(part)).sum())
                    found.append((rule.name, time.thread_time() - began, rejected, part.n))
            names, seconds, rejected, rows = zip(*found, strict=True) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(seconds, pa.float64()),
                                              pa.array(rejected, pa.int64()), pa.array(rows, pa.int64())],
                                             ["rule", "seconds", "rejected", "rows"])

    sample = docs.select(text).sample(fraction=min(1.0, sample_rows / total), seed=11)
    sums = sample.mapInArrow(measure, schema).groupBy("rule").agg(
        F.sum("seconds").alias("s"), F.sum("rejected").alias("r"), F.sum("rows").alias("n")).collect()
    found = {x.rule: (x.s / x.n, x.r / x.n) for x in sums}
    return {r.name: found.get(r.name, (1.0, 0.0)) for r in rules}


def ordered(rules: tuple[Rule, ...], estimates: dict[str, tuple[float, float]]) -> tuple[Rule, ...]:
    """The rules by falling rejection per cost; ties keep their given order."""
    return tuple(sorted(rules, key=lambda r: -estimates[r.name][1] / max(estimates[r.name][0], 1e-9)))


def run_cascade(seen: Measures, rules: tuple[Rule, ...]) -> np.ndarray:
    """Index of the first rule in order that rejects each document, -1 for kept ones; a rule sees only what is left."""
    verdict, left = np.full(seen.n, -1), np.arange(seen.n)
    for k, rule in enumerate(rules):
        if not len(left):
            break
        failed = rule.fails(seen)
        if failed.any():
            verdict[left[failed]] = k
            left, seen = left[~failed], seen.narrowed(~failed)
    return verdict


def cascade(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", measures: tuple[str, ...] = (),
            sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Add ``kept`` (no rule rejects) and ``rejected_by`` (the rule that stopped the cascade, or null).

    ``measures`` names counts to return for every document; they are then computed for rejected ones too, and the rules
    reuse them.
    """
    order = ordered(rules, estimate(docs, rules, text, sample_rows))
    names = np.array([*(r.name for r in order), None], object)

    def judge(column: pa.Array) -> list:
        found: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in (*measures, "verdict")]
        for part in slices(column):
            seen = Measures(part)
            for k, m in enumerate(measures):
                found[k].append(getattr(seen, m))
            found[-1].append(run_cascade(seen, order))
        *counts, verdict = (np.concatenate(x).astype(np.int64) for x in found)
        return [*counts, verdict < 0, names[verdict].tolist()]

    return with_columns(docs, [*(field(m, "bigint") for m in measures), field("kept", "boolean"),
                               field("rejected_by", "string")], judge, text)
