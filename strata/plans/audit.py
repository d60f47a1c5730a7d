"""What each layer holds."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources import tables

REPORT_SCHEMA = "layer STRING, table STRING, rows LONG, files LONG, valid LONG, quarantined LONG"


def layer_report(spark: SparkSession, listed: Iterable[tuple[str, str]]) -> DataFrame:
    """One row per ``(layer, table)``: its rows, distinct source files, and for silver the valid and quarantined
    rows. An absent table has NULL counts. Each table is read once, for the columns counted only. In place of a table
    name the path of a Parquet folder may be given."""
    parts = [_summary(spark, layer, table) for layer, table in listed]
    if not parts:
        return spark.createDataFrame([], REPORT_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def _summary(spark: SparkSession, layer: str, table: str) -> DataFrame:
    label = [F.lit(layer).alias("layer"), F.lit(table).alias("table")]
    if not _is_path(table) and not tables.exists(spark, table):
        return spark.range(1).select(*label, *[
            F.lit(None).cast("long").alias(c) for c in ("rows", "files", "valid", "quarantined")])
    bad_table = f"{table}_quarantine"
    df = _open(spark, table).withColumn("_bad", F.lit(False))
    if layer == "silver" and not _is_path(table) and tables.exists(spark, bad_table):
        bad = tables.read(spark, bad_table).withColumn("_bad", F.lit(True))
        df = df.unionByName(bad, allowMissingColumns=True)
    # Distinct files by two plain aggregates: the first leaves one row per file.
    has_files = "source_file" in df.columns
    per_file = df.groupBy(F.col("source_file") if has_files else F.lit(None).cast("string").alias("source_file"))
    per_file = per_file.agg(F.count_if(~F.col("_bad")).alias("_good"), F.count_if("_bad").alias("_bad"))
    totals = per_file.agg(
        F.coalesce(F.sum("_good"), F.lit(0)).alias("rows"),
        (F.count("source_file") if has_files else F.lit(None).cast("long")).alias("files"),
        F.coalesce(F.sum("_bad"), F.lit(0)).alias("_bad"))
    silver = layer == "silver"
    return totals.select(
        *label, (F.col("rows") + F.col("_bad")).alias("rows") if silver else "rows", "files",
        (F.col("rows") if silver else F.lit(None).cast("long")).alias("valid"),
        (F.col("_bad") if silver else F.lit(None).cast("long")).alias("quarantined"))


def _is_path(table: str) -> bool:
    return "/" in table


def _open(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.parquet(table) if _is_path(table) else tables.read(spark, table)


def sample_rows(spark: SparkSession, table: str, n: int = 5) -> DataFrame:
    """A few rows of a table or Parquet folder, to look at."""
    return _open(spark, table).limit(n)


def source_files(df: DataFrame) -> DataFrame:
    """The distinct files that rows came from."""
    return df.select("source_file").distinct()
