"""Removal of boilerplate lines by the number of sites that show them, in DataFrame operations only.

Each line hash gets a HyperLogLog sketch of its sites; sketches merge by aggregation, so the state per line is bounded
however many sites it has. Lines whose estimate is too close to the threshold to be sure get an exact distinct count.
Lines shown by at least ``min_sites`` sites, and by more than one text (copies of one document are another operator's
concern), are removed wherever they stand.

Line hashes are written once to the shared folder; texts are read once for the hashes and once for the removal.

Edge cases: a null text stays null and has no lines; blank lines are never boilerplate and stay; a null site is a site
of its own; a text that is all boilerplate becomes empty but its row stays; equal rows get equal results; other columns
pass through; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.components import stored
from strata.llm.frames import col, unused

MIN_SITES = 10
LG_K = 12
SIGMAS = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _worded(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def line_table(docs: DataFrame, site: str = "source", text: str = "text") -> DataFrame:
    """``line, site, text``: 64-bit hashes, one row per different line of a document that holds a word."""
    hashes = F.transform(F.filter(_lines(col(text)), _worded), lambda x: F.xxhash64(x))
    return docs.select(F.explode(F.array_distinct(hashes)).alias("line"), F.xxhash64(col(site)).alias("site"),
                       F.xxhash64(col(text)).alias("text"))


def spread(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """``line, sites`` of the boilerplate lines; ``sites`` is exact near the threshold, an estimate above it."""
    estimate = F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k)))
    seen = lines.groupBy("line").agg(estimate.alias("sites"), F.min("text").alias("t0"), F.max("text").alias("t1"))
    seen = seen.filter("t0 != t1").select("line", "sites")
    # Estimates are rounded to whole sites, so one more on both sides.
    margin = SIGMAS * 1.04 / 2 ** (lg_k / 2) * min_sites + 1
    seen = stored(seen.filter(F.col("sites") >= min_sites - margin), "spread")
    sure = seen.filter(F.col("sites") > min_sites + margin)
    near = seen.filter(F.col("sites") <= min_sites + margin).select("line")
    exact = lines.join(near, "line").groupBy("line", "site").agg(F.lit(1)).groupBy("line").agg(F.count("*").alias("sites"))
    return sure.unionByName(exact.filter(F.col("sites") >= min_sites))


def remove_boilerplate(docs: DataFrame, site: str = "source", text: str = "text", min_sites: int = MIN_SITES,
                       lg_k: int = LG_K, counts: bool = True) -> DataFrame:
    """``docs`` with the boilerplate lines gone from the text; ``n_lines`` and ``n_removed`` count lines.

    Without ``counts`` only the columns of ``docs`` return.
    """
    lines = stored(line_table(docs, site, text), "lines")
    # Names that no column of the documents has.
    of, key, boiler = (unused(docs, n) for n in ("_text", "_key", "_gone"))
    gone = lines.join(spread(lines, min_sites, lg_k).select("line"), "line").groupBy(
        F.col("text").alias(key)).agg(F.collect_set("line").alias(boiler))
    found = docs.withColumn(of, F.xxhash64(col(text))).join(gone, F.col(of) == F.col(key), "left")
    split = _lines(col(text))
    left = F.filter(split, lambda x: ~F.array_contains(boiler, F.xxhash64(x)) | ~_worded(x))
    size = lambda x: F.coalesce(F.when(col(text).isNotNull(), F.size(x)), F.lit(0)).cast("long")
    cut = F.when(F.col(boiler).isNull(), col(text)).otherwise(F.array_join(left, "\n"))
    own = [cut.alias(c) if c == text else col(c) for c in docs.columns if not counts or c not in ("n_lines", "n_removed")]
    if not counts:
        return found.select(*own)
    removed = F.when(F.col(boiler).isNull(), F.lit(0).cast("long")).otherwise(size(split) - size(left))
    return found.select(*own, size(split).alias("n_lines"), removed.alias("n_removed"))


