"""The pipeline's stages against plain statements, each on what its predecessor kept."""

import brute

import corpus_pipeline
from strata.llm import toxicity

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near dedup", "decontamination", "mixing"]
    model = toxicity.train_on_labels(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    rows = {r.doc_id: r for r in docs.collect()}
    at = docs
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, FOLDER).cache()
        found = {r.doc_id: r for r in at.collect()}
        if name == "toxicity":
            assert set(found) == {i for i in rows if scores[i] < toxicity.THRESHOLD}
        elif name == "line dedup":
            left = brute.boilerplate([(r.source, r.text) for r in rows.values()])
            assert {i: r.text for i, r in found.items()} == {i: x[0] for i, x in zip(rows, left, strict=True)}
        elif name == "near dedup":
            of = brute.components([(i, brute.fingerprint(r.text)) for i, r in rows.items()])
            assert set(found) == set(of)
        elif name == "decontamination":
            hit = brute.contamination([r.text for r in rows.values()], bench)
            assert set(found) == {i for i, x in zip(rows, hit, strict=True) if not x[4]}
        else:
            assert set(found) == set(rows) and all(r.taken <= 3 * r.size for r in found.values())
            break
        assert at.columns == docs.columns
        rows = found


def test_run(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 50
