"""A corpus pipeline of five stages: toxicity, line dedup, near-dedup, decontamination, mixing.

Each stage takes all rows its predecessor kept and is written as Parquet and read again before the next one. All but the
last return the columns of ``documents``; the last says how many words of each document the mix takes.

Edge cases are those of the operators: null texts count as empty, repeated rows are rows of their own until the
near-dedup stage, extra columns pass through the filtering stages, and empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontam, lines, mixing, simhash, toxicity
from strata.session import shared_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, does not reject."""
    model = toxicity.train_on_labels(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.filter_toxic(docs, model)


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten or more sources share."""
    return lines.remove_boilerplate(docs, counts=False)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (three-word shingles, fingerprints of 3 or fewer differing bits)."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` of every document."""
    return mixing.taken(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate_lines),
    ("near dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_dir(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
