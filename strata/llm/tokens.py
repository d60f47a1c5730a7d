"""Token counts by a map-side two-tier lookup: no text and no pre-token is ever shuffled.

The tokenizers served here drop white space and make no token across it, so a text has as many tokens as its pre-tokens
have together; a tokenizer for which that does not hold is refused. Texts of Latin-1 characters are cut into the
tokenizer's own pre-tokens (words, digits, punctuation) where its rules are the known ones; anything else is cut at white
space only, and the library does the rest.

The first tier is a compact table of the lengths of frequent pre-tokens, counted on a bounded random sample of rows and
broadcast: at most ``ENTRIES`` pre-tokens of at most ``PIECE_BYTES`` bytes, so 2.2 MB by default whatever the input. The
second tier is a bounded cache in each Python worker, which lives as long as the worker does; what neither tier knows is
given to the tokenizer's own library. Sample and caches decide how fast a count is found, never what it is.

Edge cases: null and empty texts and texts of white space have no tokens; pre-tokens too long for the caches are encoded
each time, whole; strings of special tokens inside texts count as the library counts them by default; equal rows get
equal counts; other columns pass through, and an output column replaces an input column of the same name; an empty table
gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import batched, chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm.frames import col, field, with_columns
from strata.llm.text import slices

ENTRIES = 1 << 16
PIECE_BYTES = 32
SAMPLE_ROWS = 2000
CACHED = 1 << 19
CACHED_CHARS = 64
BLANKS = re.compile(r"[ \t-\r]+")

# The rules of tokenizers whose pre-tokens are known here.
NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# The same split of lower-cased Latin-1 text, which those rules leave as it is otherwise.
_LETTERS, _DIGITS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
LATIN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^ \\t-\\r\x85\xa0{_LETTERS}{_DIGITS}]+")


def load(spec: str) -> Tokenizer:
    """The tokenizer that a JSON text describes, without truncation and padding."""
    out = Tokenizer.from_str(spec)
    out.no_truncation()
    out.no_padding()
    return out


def length(tokenizer: Tokenizer, piece: str) -> int:
    return len(tokenizer.encode(piece, add_special_tokens=False).ids)


def check_splits_at_blanks(tokenizer: Tokenizer) -> None:
    """Refuse a tokenizer whose tokens take in white space or depend on it."""
    for left, right in (("a", "b"), ("it", "'s"), ("1", "2"), (".", "!"), ("\xe9", "\u0301"), ("", "a")):
        for blank in " \t\n\r\x0b\x0c":
            for gap in (blank, blank + " "):
                if length(tokenizer, left + gap + right) != length(tokenizer, left) + length(tokenizer, right):
                    raise ValueError("the tokenizer's tokens depend on white space; its texts cannot be counted by pre-token")


def _is_latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Rules:
    """How texts are cut into pieces that the tokenizer of a JSON text treats one by one."""

    def __init__(self, spec: str):
        rules = json.loads(spec)
        self.marks = [t["content"] for t in rules.get("added_tokens") or ()]
        cuts = (rules.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.known = ((rules.get("normalizer") or {}).get("normalizers") == NORMAL
                      and cuts[0].get("pattern") == {"Regex": SPLIT} and cuts[0].get("behavior") == "Removed"
                      and cuts[0].get("invert") is True
                      and all(c.get("type") == "ByteLevel" and not c.get("use_regex", True) for c in cuts[1:]))

    def plain(self, text: str) -> bool:
        """Whether the pattern above cuts the text as the tokenizer does."""
        return self.known and _is_latin(text) and not any(m in text for m in self.marks)

    def cut(self, text: str) -> list[str]:
        if self.plain(text):
            return LATIN.findall(text.lower())
        pieces = [p for p in BLANKS.split(text) if p]
        odd = [p for p in pieces if not self.plain(p)]
        return LATIN.findall(" ".join(p for p in pieces if self.plain(p)).lower()) + odd


class Lookup:
    """Both tiers in one dictionary; the second is dropped when it has grown beyond its bound."""

    def __init__(self, spec: str, table: Table):
        self.tokenizer, self.rules = load(spec), Rules(spec)
        self.frequent = dict(zip(table.pieces.split("\n"), table.lengths, strict=True)) if table.lengths else {}
        self.lengths = dict(self.frequent)

    def encode(self, pieces: list[str]) -> Iterator[tuple[str, int]]:
        """Lengths by the library. Plain pre-tokens go to it in lines of many, which it cuts into just these again."""
        for some in batched((p for p in pieces if self.rules.plain(p)), 4096):
            words = [w for w in self.tokenizer.encode(" ".join(some), add_special_tokens=False).word_ids]
            counts = np.bincount(words, minlength=len(some))
            if len(counts) != len(some) or not counts.all():
                counts = [length(self.tokenizer, p) for p in some]
            yield from zip(some, map(int, counts), strict=True)
        for piece in pieces:
            if not self.rules.plain(piece):
                yield piece, length(self.tokenizer, piece)

    def count(self, texts: list[str]) -> list[int]:
        cuts = [self.rules.cut(t) for t in texts]
        missing = list(set(chain.from_iterable(cuts)).difference(self.lengths))
        self.lengths.update(self.encode(missing))
        out = [sum(map(self.lengths.__getitem__, c)) for c in cuts]
        for piece in missing:
            if len(piece) > CACHED_CHARS:
                del self.lengths[piece]
        if len(self.lengths) > len(self.frequent) + CACHED:
            self.lengths = dict(self.frequent)
        return out


@dataclass(frozen=True)
class Table:
    """Pre-tokens, joined by line ends (they hold none), and one byte each for their lengths."""

    pieces: str = ""
    lengths: bytes = b""


def frequent(docs: DataFrame, spec: str, text: str = "text", sample_rows: int = SAMPLE_ROWS,
             entries: int = ENTRIES) -> Table:
    """The most frequent short pre-tokens of about ``sample_rows`` random rows, with their lengths."""
    total = docs.count()
    if not total or not entries:
        return Table()

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, seen = Rules(spec).cut, Counter()
        for batch in batches:
            for part in slices(batch.column(0)):
                for k in range(part.n):
                    seen.update(cut(part.text(k).decode()))
                if len(seen) > 16 * entries:  # bounded: rare ones go
                    seen = Counter(dict(seen.most_common(4 * entries)))
        best = [x for x in seen.most_common(entries) if len(x[0].encode()) <= PIECE_BYTES]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in best], pa.string()),
                                          pa.array([n for _, n in best], pa.int64())], ["piece", "n"])

    sample = docs.select(col(text)).sample(fraction=min(1.0, sample_rows / total), seed=17)
    best = sample.mapInArrow(tally, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    pieces = [r.piece for r in best.orderBy(F.desc("n"), "piece").limit(entries).collect()]
    found = [(p, n) for p, n in Lookup(spec, Table()).encode(pieces) if n < 256]
    return Table("\n".join(p for p, _ in found), bytes(n for _, n in found))


# Of this worker process: lookups by tokenizer and table, kept from task to task.
_LOOKUPS: dict[bytes, Lookup] = {}


def lookup(spec: str, table: Table) -> Lookup:
    key = sha256(b"\0".join((spec.encode(), table.pieces.encode(), table.lengths))).digest()
    if key not in _LOOKUPS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _LOOKUPS.clear()
        _LOOKUPS[key] = Lookup(spec, table)
    return _LOOKUPS[key]


def count(docs: DataFrame, tokenizer: str, text: str = "text", output: str = "n_tokens", n_bytes: str = "n_bytes",
          sample_rows: int = SAMPLE_ROWS, entries: int = ENTRIES, keep_text: bool = True) -> DataFrame:
    """Add the UTF-8 bytes and the tokens of each text. ``tokenizer`` is the path of a JSON file that the driver reads;
    it goes to the workers with the table. One map over the documents, after one over the sample."""
    spec = Path(tokenizer).read_text(encoding="utf-8")
    check_splits_at_blanks(load(spec))
    table = frequent(docs, spec, text, sample_rows, entries)
    shared = docs.sparkSession.sparkContext.broadcast((spec, table))

    def run(column: pa.Array) -> list:
        known = lookup(*shared.value)
        sizes, counts = [np.zeros(0, np.int64)], []
        for part in slices(column):
            sizes.append(part.lengths)
            counts += known.count([part.text(k).decode() for k in range(part.n)])
        return [np.concatenate(sizes), np.array(counts, np.int64)]

    return with_columns(docs, [field(n_bytes, "bigint"), field(output, "bigint")], run, text, keep_text)
