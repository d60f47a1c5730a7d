"""Spelling variants, token counts and the conversation trie against plain statements of their results."""

import random

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from strata.llm import tokens, tries, variants

SPEC = public_tokenizers.path("word_bpe_49k.json")


# --- spelling variants --------------------------------------------------------------------------------------------------

def spelled():
    rng = random.Random(8)
    stems = ["letter", "Été-çaà", "ÀÉÎõü", "banana", "abcde", "fghijk", "straße", "z" * 300, "ñandú÷×"]
    letters = "abcdeéßÿ"

    def bent(w):
        at, kind = rng.randrange(len(w)), rng.randrange(4)
        return [w, w[:at] + w[at + 1:], w[:at] + rng.choice(letters) + w[at + 1:], w[:at] + rng.choice(letters) + w[at:]][kind]

    docs = [(None, "letter lettre"), (1, None), (2, ""), (3, "1234 !! \n"), (4, "letter " * 50), (4, "letter " * 50)]
    docs.append((300, "chains " * 20 + "chaint " * 8 + "chaiut " * 3))
    return docs + [(k, " ".join(bent(rng.choice(stems)) for _ in range(80))) for k in range(5, 60)]


@pytest.mark.parametrize(("tile", "typo"), [(2048, 97), (3, 2)])
def test_spelling_variants(spark, tile, typo):
    docs = spelled()
    frame = spark.createDataFrame([(i, t, "own", "own") for i, t in docs], "doc_id LONG, text STRING, word STRING, n STRING")
    found = variants.group(frame.repartition(3), tile=tile, typo=typo)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    expected = brute.variants(docs, typo=typo)
    assert sorted(map(tuple, found.collect()), key=str) == expected
    assert any(x[1] for x in expected) and any(x[2] != x[1] and x[1] for x in expected)
    assert variants.group(frame.filter("false")).count() == 0


def test_distances_hold_every_edit():
    rng = np.random.default_rng(3)
    words = sorted({"".join(rng.choice(list("abà"), rng.integers(5, 8))) for _ in range(400)})
    for short in (5, 6, 7):
        left = np.array([w for w in words if len(w) == short], object)
        for long in (short, short + 1):
            right = np.array([w for w in words if len(w) == long], object)
            if not len(right):
                continue
            i, j = variants.near_pairs(left, right, short == long)
            expected = {(a, b) for a in range(len(left)) for b in range(len(right)) if (short != long or a < b)
                        and variants.one_edit(variants._codes(left[[a]]), variants._codes(right[[b]]), short == long)[0]}
            assert set(zip(i.tolist(), j.tolist(), strict=True)) == expected and expected


def test_steps_tell_blocks_apart():
    steps = variants._steps()
    signed = {(sign * n % variants.PRIME, sign * longer) for n, longer in steps[1:] for sign in (1, -1)}
    assert len(signed) == 2 * len(steps[1:]) and (0, 0) not in signed


# --- token counts -------------------------------------------------------------------------------------------------------

def odd_texts():
    rng = random.Random(1)
    latin = "".join(map(chr, range(256)))
    wide = ("aAbB'sStTréÉé́ñ中日  \u0085\x1c\x1d 0123½²İΣςßǅ́.,!?-_ \t\n\r\x0b\x0c　\U0001f642"
            "‍ſK")
    marks = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "it's", "we'LL", "x'"]
    made = ["".join(rng.choice(pool) if rng.random() < 0.9 else rng.choice(marks) for _ in range(rng.randrange(60)))
            for pool in (latin, wide) for _ in range(300)]
    return [None, "", " \n\t ", "a", "a" * 200_000, "!" * 50_000, "word " * 5000, "word " * 5000, *made]


def test_token_counts(spark):
    texts = odd_texts()
    plain = tokens.load(open(SPEC, encoding="utf-8").read())
    docs = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)], "doc_id LONG, text STRING, N_TOKENS STRING")
    expected = {i: (len((t or "").encode()), len(plain.encode(t or "", add_special_tokens=False).ids))
                for i, t in enumerate(texts)}
    for entries, sample in ((0, 0), (50, 100), (1 << 16, 2000)):
        found = tokens.count(docs.repartition(3), SPEC, sample_rows=sample, entries=entries)
        assert found.columns == ["doc_id", "text", "n_bytes", "n_tokens"]
        assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in found.collect()} == expected
    assert tokens.count(docs, SPEC, keep_text=False).columns == ["doc_id", "n_bytes", "n_tokens"]
    assert tokens.count(docs.filter("false"), SPEC).count() == 0


def test_full_caches_and_other_rules_change_no_count(monkeypatch):
    texts = [t or "" for t in odd_texts()]
    spec = open(SPEC, encoding="utf-8").read()
    expected = tokens.Lookup(spec, tokens.Table()).count(texts)
    monkeypatch.setattr(tokens, "CACHED", 10)
    small = tokens.Lookup(spec, tokens.Table("word\nthe", bytes([1, 1])))
    assert [small.count([t])[0] for t in texts] == expected and len(small.lengths) < 500
    monkeypatch.setattr(tokens, "SPLIT", "unknown")
    assert tokens.Lookup(spec, tokens.Table()).count(texts) == expected


def test_tokens_that_depend_on_blanks_are_refused():
    spec = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    with pytest.raises(ValueError, match="white space"):
        tokens.check_splits_at_blanks(tokens.load(spec))


# --- conversation trie ----------------------------------------------------------------------------------------------------

def talks():
    rng = random.Random(9)
    rows = [(None, 1, "user", "lost"), (7, None, "user", "first"), (7, 1, None, None), (7, 1, "user", "é"), (7, 1, "user", "é"),
            (-3, 0, "user", "below zero"), (3, 2, "", "x"), (3, 2, None, "x")]
    for c in range(10, 60):
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "b", "日本"])) for t in range(rng.randrange(1, 12))]
    rows += [(c, t, "user", "same") for c in range(60, 90) for t in range(30 + (c % 3))]
    return rows + [(200, t, "user", str(t % 3)) for t in range(170)]


@pytest.mark.parametrize("piece", [64, 4, 2])
def test_conversation_trie(spark, piece):
    rows = talks()
    table = spark.createDataFrame([(*r, "own", "own") for r in rows],
                                  "conv_id LONG, turn LONG, role STRING, text STRING, depth STRING, name STRING")
    found = tries.nodes(tries.crossed(table.repartition(4)), piece)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert found.columns == columns
    assert sorted(map(tuple, found.collect()), key=str) == brute.trie(brute.crossed(rows))


def test_empty_conversations(spark):
    table = spark.createDataFrame([], "conv_id LONG, turn LONG, role STRING, text STRING")
    assert tries.nodes(tries.crossed(table)).count() == 0
    bare = spark.createDataFrame([(5, 1, "user", "only")], table.schema)
    assert tries.nodes(tries.crossed(bare)).filter(F.col("depth") == 0).count() == 1


def test_halves_name_sequences():
    names = {}
    rng = random.Random(2)
    for _ in range(300):
        turns = [rng.choice([b"a", b"b"]) for _ in range(rng.randrange(1, 9))]
        for d, name in enumerate(tries.halves(turns), 1):
            assert names.setdefault(name, turns[:d]) == turns[:d]
    assert len(names) == len({tuple(v) for v in names.values()})


# --- toxicity -----------------------------------------------------------------------------------------------------------

def test_learning_and_scoring_agree_with_plain_dictionaries():
    import math

    import pyarrow as pa

    from strata.llm import toxicity
    from strata.llm.text import slices
    rng = random.Random(6)
    texts = [" ".join(rng.choices(["good", "Words", "hére", "vile", "more"], k=rng.randrange(0, 30))) for _ in range(150)]
    labels = np.array([float("vile" in t) for t in texts])
    rows = []
    for part in slices(pa.array(texts), 500):
        docs, slots = toxicity.features(part, 12)
        rows += np.split(slots, np.searchsorted(docs, np.arange(1, part.n)))
    assert all((toxicity.unpack(toxicity.pack(r)) == r).all() for r in [*rows, np.array([0, 70000, 1 << 19])])
    rates = toxicity.Rates(l1=0.3)
    z, n = {}, {}
    weight = lambda i: 0.0 if abs(z.get(i, 0.0)) <= rates.l1 else (
        math.copysign(rates.l1, z[i]) - z[i]) / ((rates.beta + math.sqrt(n[i])) / rates.alpha + rates.l2)
    for _ in range(rates.passes):
        for row, y in zip(rows, labels, strict=True):
            w = {int(i): weight(int(i)) for i in row}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y
            for i, v in w.items():
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / rates.alpha
                z[i] = z.get(i, 0.0) + g - sigma * v
                n[i] = n.get(i, 0.0) + g * g
    model = toxicity.ftrl(toxicity.Packed([toxicity.pack(r) for r in rows]), labels, 12, rates)
    expected = {i: weight(i) for i in z if weight(i)}
    assert dict(zip(model.slots.tolist(), model.weights.tolist(), strict=True)) == pytest.approx(expected)
    # Slots of weight zero left out or not, the sums are the same.
    dense = model.dense()
    for part in slices(pa.array(texts), 500):
        sums = [np.bincount(d, dense[s], minlength=part.n) for d, s in (
            toxicity.features(part, 12), toxicity.features(part, 12, dense != 0))]
        assert sums[0] == pytest.approx(sums[1])
