"""The text operators against plain statements of their results, on hand-made rows with all the odd cases."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from oracle import connect, duck_rows, spark_rows
from strata.llm import decontam, html, lines, mixing, pii, quality, simhash, suffixes, toxicity, urls
from strata.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id LONG, text STRING, source STRING, kept STRING, score STRING"


def made(spark, texts, schema=SCHEMA):
    """Documents 0, 1, ... with columns whose names clash with those of results."""
    return spark.createDataFrame([(i, t, f"s{i % 12}", "own", "own") for i, t in enumerate(texts)], schema).repartition(3)


def odd_texts():
    rng = random.Random(3)
    words = ["alpha", "Beta", "été", "日本", "x", "gamma,", "DELTA!"]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = prose(60)
    return [None, "", " \n\t ", "one", "a b", prose(5000), shared, shared, f"{prose(20)} {shared}\n{prose(9)}",
            shared[:150], "a" * 900, "a" * 901, "ab" * 300, "same line\n" * 40, "### $$$ ||| " * 30, prose(120).upper(),
            *[prose(30 + k) + "\nboiler plate line here\n" + prose(20) for k in range(14)]]


def by_id(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in df.collect()}


def test_quality(spark):
    texts = odd_texts()
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    found = by_id(quality.cascade(made(spark, texts), measures=counts), *counts, "kept")
    assert found == {i: (*brute.quality(t)[:5], brute.quality(t)[6]) for i, t in enumerate(texts)}
    short = by_id(quality.cascade(made(spark, texts)), "kept")
    assert short == {i: v[-1:] for i, v in found.items()}


def test_rules_run_by_rejection_per_cost():
    rules = tuple(quality.Rule(n, None) for n in "abc")
    order = quality.ordered(rules, {"a": (1.0, 0.1), "b": (0.1, 0.1), "c": (10.0, 0.9)})
    assert [r.name for r in order] == ["b", "a", "c"]


@pytest.mark.parametrize("group", [4096, 2])
def test_repeats(spark, group):
    texts = [t for t in odd_texts() if t is None or len(t) < 6000]
    columns = ("n_bytes", "n_removed", "n_spans", "sha")
    for length, gram in ((200, 32), (40, 8)):
        found = suffixes.remove_repeats(made(spark, texts), length=length, gram=gram, group=group)
        found = by_id(found.withColumn("sha", F.sha2("kept", 256)), *columns)
        assert found == dict(enumerate(brute.repeats(texts, length)))


def test_column_wise_order_marks_repeats():
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(97, 99, rng.integers(12, 30))) for _ in range(60)]
    offs = np.array([rng.integers(0, 4) for _ in texts])
    counts = np.array([len(t) - 9 for t in texts])
    times = np.array([1 + (k % 7 == 0) for k in range(len(texts))])
    marks = suffixes.repeats(texts, offs, counts, times, 10)
    for i, t in enumerate(texts):
        for s in range(counts[i]):
            again = times[i] > 1 or any(j != i and 0 <= s - offs[i] + offs[j] < counts[j] and u[
                s - offs[i] + offs[j]:][:10] == t[s:s + 10] for j, u in enumerate(texts))
            assert marks[i, s] == again


def test_boilerplate_lines(spark):
    texts = odd_texts()
    found = by_id(lines.remove_boilerplate(made(spark, texts)), "text", "n_lines", "n_removed")
    assert found == dict(enumerate(brute.boilerplate([(f"s{i % 12}", t) for i, t in enumerate(texts)])))
    assert sum(v[2] for v in found.values()) == 14


@pytest.mark.parametrize("block", [200_000, 3])
def test_decontamination(spark, block):
    texts = odd_texts()
    items = [(1, texts[5][100:300]), (2, "ALPHA beta"), (3, None), (4, "..."), (None, texts[6]), (5, "absent words here"),
             (6, texts[5][100:300])]
    bench = spark.createDataFrame(items, "item_id LONG, text STRING")
    found = decontam.digest(decontam.find(made(spark, texts), bench, block_windows=block))
    named = [("null" if i is None else i, t) for i, t in items]
    assert by_id(found, "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == dict(
        enumerate(brute.contamination(texts, named)))
    clean = decontam.clean(made(spark, texts), bench)
    assert clean.columns == made(spark, texts).columns
    assert {r.doc_id for r in clean.collect()} == {i for i, x in enumerate(brute.contamination(texts, named)) if not x[4]}


def test_html():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><body><h1>Head&amp;line</h1>
      <p>One <b>bold</b><p>Two<br>lines <span style="display: none">no</span><script>var x = "</p>"</script>
      <ul><li>a<li>b<ol start=3><li>c</ol></ul><div hidden>no</div><pre>  keep
   this</pre><table><tr><td>long cell<td>1<tr><td>x<td>22</table>tail"""
    assert html.render(html.build(page)) == (
        "Head&line\n\nOne bold\n\nTwo\nlines\n\n- a\n- b\n  3. c\n\n  keep\n   this\n\nlong cell  1\nx          22\n\ntail")
    assert html.render(html.build("<div>" * 20000 + "deep")) == "deep"
    assert html.render(html.build("")) == "" and html.render(html.build("a < b")) == "a < b"


def test_toxicity(spark):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(200)]
    rows = [(i, " ".join(rng.choices(words, k=40) + (["vile"] if i % 4 == 0 else [])), int(i % 4 == 0), "x")
            for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, toxic INT, score STRING")
    model = toxicity.train_on_labels(docs.drop("toxic"), docs.select("doc_id", "toxic"))
    found = toxicity.score(docs, model).withColumns({
        "held": toxicity.held_out(F.col("doc_id")), "predicted": (F.col("score") >= toxicity.THRESHOLD).cast("int")})
    held = found.filter("held").collect()
    assert held and all(0 <= r.score <= 1 for r in held)
    assert sum(r.toxic == r.predicted for r in held) >= 0.95 * len(held)
    assert len(model.slots) < 2000
    kept = toxicity.filter_toxic(docs, model)
    assert kept.columns == docs.columns and 400 <= kept.count() <= 500
    odd = toxicity.score(made(spark, [None, ""]), model).collect()
    assert len({r.score for r in odd}) == 1
    none = toxicity.fit(docs.filter("false").withColumn("toxic", F.lit(1)))
    assert toxicity.score(docs, none).select("score").distinct().count() == 1


def test_cover_brings_near_values_together():
    rng = np.random.default_rng(2)
    cover = simhash.Cover(1)
    x = rng.integers(0, 1 << 32, 400)
    y = x ^ (1 << rng.integers(0, 32, 400))
    near = [[set(), set()] for _ in x]
    for which, values in enumerate((x, y)):
        for row, anchor in zip(*cover.anchors(values), strict=True):
            near[row][which].add(anchor)
    assert all(a & b for a, b in near)
    assert np.mean([len(a) for a, _ in near]) < 12


@pytest.mark.parametrize("group", [2048, 4])
def test_links_find_all_components(spark, group):
    rng = random.Random(4)
    values = [rng.getrandbits(64) for _ in range(150)]
    for v in list(values):
        for _ in range(rng.randrange(4)):
            v ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            values.append(v)
    values = sorted(set(values))
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    nodes = spark.createDataFrame([(signed(v),) for v in values], "fp LONG")
    found = {r.fp: r.root for r in simhash.roots(nodes).collect()} if group == 2048 else None
    if found is None:
        from strata.llm.components import components
        links = simhash.links(nodes, group=group)
        found = {signed(v): signed(v) for v in values} | {r.node: r.root for r in components(links).collect()}
    expected = brute.components([(signed(v), v) for v in values])
    assert [found[signed(v)] for v in values] == expected


def test_simhash(spark):
    texts = odd_texts()
    prints = [brute.fingerprint(t) for t in texts]
    found = by_id(simhash.near_duplicates(made(spark, texts)), "fingerprint", "component_id")
    expected = brute.components(list(enumerate(prints)))
    assert found == {i: (f"{p:016x}", c) for i, (p, c) in enumerate(zip(prints, expected, strict=True))}
    docs = made(spark, texts)
    kept = simhash.keep_one(docs.union(docs))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected))


def test_suffix_names_may_clash(spark):
    names = ("k1", "k2", "_k1", "_k2", "_f1", "starts", "_starts", "_packed", "h", "ph", "pieces", "bytes")
    docs = made(spark, odd_texts())
    wide = docs.withColumns({n: F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string")) for n in names})
    counts = ("n_bytes", "n_removed", "n_spans", "kept")
    found = suffixes.remove_repeats(wide.unionByName(wide))  # every row twice: all strings stand elsewhere
    plain = by_id(suffixes.remove_repeats(docs.unionByName(docs)), *counts)
    rows = found.collect()
    assert len(rows) == 2 * len(plain) and set(found.columns) == {*wide.columns, *counts}
    assert all(tuple(r[c] for c in counts) == plain[r.doc_id] and r[n] == f"{n}:{r.doc_id}" for r in rows for n in names)


def test_inner_names_may_clash(spark):
    names = ("_text", "_key", "_gone", "_row", "_fp", "_kept_id", "_kept_row", "line", "fp", "root", "id", "n_words", "row")
    docs = made(spark, odd_texts()).withColumns({n: F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string")) for n in names})
    bench = spark.createDataFrame([(1, "absent words here")], "item_id LONG, text STRING")
    own = {i: v for i, v in by_id(docs, *names).items()}
    for df in (lines.remove_boilerplate(docs, counts=False), simhash.keep_one(docs), simhash.near_duplicates(docs),
               decontam.clean(docs, bench), toxicity.filter_toxic(docs, toxicity.fit(docs.filter("false").withColumn(
                   "toxic", F.lit(1))))):
        found = by_id(df, *names)
        assert found == {i: own[i] for i in found}
    assert len(by_id(simhash.keep_one(docs), "row")) == len(by_id(simhash.keep_one(made(spark, odd_texts())), "kept"))


def test_candidates_are_compared_in_bounded_numbers(spark, monkeypatch):
    texts = odd_texts()
    words = " ".join(w for w in texts[5].split()[:400])
    bench = spark.createDataFrame([(i, words) for i in range(5)], "item_id LONG, text STRING")
    blocks = list(decontam.blocks(bench))
    whole = [b.occurrences(next(decontam.slices(pa.array([texts[5]])))) for b in blocks]
    monkeypatch.setattr(decontam, "CANDIDATES", 3)
    again = [b.occurrences(next(decontam.slices(pa.array([texts[5]])))) for b in blocks]
    ordered = lambda found: sorted((s, e, tuple(i)) for s, e, i in found[1][0])
    assert ordered(whole[0]) == ordered(again[0]) and len(whole[0][1][0]) >= 300


def test_mixing(spark):
    texts = [None, "", *(" ".join(["w"] * (k % 37 + 1)) for k in range(300))]
    docs = made(spark, texts).withColumn("source", F.when(F.col("doc_id") % 3 > 0, F.col("source")))
    rows = mixing.taken(docs, slot_tokens=16).collect()
    assert len(rows) == len(texts) and all(r.taken <= 3 * r.size for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.source, [0, r.target])[0] += r.taken
    assert all(abs(t - target) <= 1 for t, target in by.values())
    assert sum(r.size for r in rows) == pytest.approx(sum(t for _, t in by.values()))
    _, pieces = mixing.mix(docs, slot_tokens=16)
    early = {r.source: r.n for r in pieces.filter("slot < 100").groupBy("source").agg(F.sum("piece").alias("n")).collect()}
    share = sum(early.values())
    assert all(abs(early.get(s, 0) / share - t / sum(x for _, x in by.values())) < 0.05 for s, (_, t) in by.items())
    assert mixing.taken(docs.filter("false")).count() == 0


def test_urls(spark):
    cases = ["http://WWW.Example.com/en/1?x#y", "http://a.example.com/en/2", "http://example.com/fr/", "http://b.net/es/1",
             "http://b.net/fr/9", "http://b.net/en/5", "http://mynet/es/1", "nothing", None, "http://x.org", "http://net/es/"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(cases)], "page_id LONG, url STRING")
    found = {r.page_id: (r.host, r.path, r.rule) for r in urls.judge(pages).collect()}
    assert [found[i] for i in range(len(cases))] == [
        ("www.example.com", "/en/1", "www.example.com/en/"), ("a.example.com", "/en/2", "example.com/en/"),
        ("example.com", "/fr/", "com/"), ("b.net", "/es/1", "net/es/"), ("b.net", "/fr/9", "net/fr/"),
        ("b.net", "/en/5", None), ("mynet", "/es/1", None), ("", "", None), ("", "", None), ("x.org", "", None),
        ("net", "/es/", "net/es/")]
    many = [(i, f"http://h.net/{'es' if i % 2 else 'fr'}/{i}") for i in range(60)] + [(99, "http://h.net/es")]
    judged = urls.judge(spark.createDataFrame(many, "page_id LONG, url STRING")).collect()
    assert {r.verdict for r in judged if r.page_id < 60} == {"block"}
    assert urls.judge(pages.filter("false")).count() == 0


def test_personal_data(spark):
    texts = [None, "", "a@b.c@d.e x@y z@w.x. (q@r.st)", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.4", "4111 1111-1111 1111 and 4111111111111112",
             "+1 (559) 555-3893, +12 +1234567890123456 ++4412345678", "é +49 30 1234567 日本 k@ü.de 12 34", "1" * 60,
             "password=5aaa9ac60bfe74b24b iban DE89 3704 0044 0532 0130 00 me (at) host.org"]
    rng = random.Random(6)
    texts += ["".join(rng.choice("a1@.+- ()9") for _ in range(80)) for _ in range(300)]
    found = by_id(pii.find(made(spark, texts)), *(f"n_{k}" for k in pii.BASE), "base_sha256")
    assert found == {i: brute.personal(t) for i, t in enumerate(texts)}
    spans = by_id(pii.find(made(spark, texts)), "spans")[8][0]
    assert "account:" in spans and "secret:" in spans and "contact:" in spans


@pytest.mark.parametrize("name", list(QUERIES))
def test_queries_on_tables(spark, name):
    run, sql = QUERIES[name]
    columns, rows = spark_rows(run(spark, FOLDER))
    assert rows
    if sql:
        assert (columns, rows) == duck_rows(connect(FOLDER), sql)


def test_empty_tables(spark):
    empty = made(spark, ["x"]).filter("false")
    bench = spark.createDataFrame([], "item_id LONG, text STRING")
    for df in (quality.cascade(empty), suffixes.remove_repeats(empty), lines.remove_boilerplate(empty),
               decontam.find(empty, bench), simhash.near_duplicates(empty), simhash.keep_one(empty), pii.find(empty),
               html.extract(empty, "text", "out")):
        assert df.count() == 0
