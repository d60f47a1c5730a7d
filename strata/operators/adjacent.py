"""Neighbouring rows of long sequences: previous, next and last-known values per key.

A plain window puts all rows of a key into one task, which fails once a key holds a large share of the data. Here the rows
of such a key are cut into chunks: the window runs per (key, chunk), and only a row or two per chunk are needed to carry
values over the chunk borders. The results are those of the plain window.

Chunks hold about ``CHUNK_ROWS`` rows each. A count per key (of the key columns alone, combined before the shuffle) finds
the keys with more rows than that; their rows are cut at equal counts by ranges of the whole order, so that neither a busy
day nor a single instant can fill a task, and are written to the shared folder, so that every later step sees the same
cuts. Keys of ordinary size are neither moved nor written for this. With a calendar ``unit`` the chunks are those units of
the order's first column instead, and no job runs beforehand.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import stored

CHUNK = "_chunk"
CHUNK_ROWS = 1_000_000


def chunked(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], unit: str | None = None,
            chunk_rows: int = CHUNK_ROWS) -> tuple[DataFrame, bool]:
    """``df`` with a ``_chunk`` that ascends with the order of each key, and whether a key can have several."""
    if unit is not None:
        return df.withColumn(CHUNK, F.date_trunc(unit, F.col(order_by[0]))), True
    named = [F.col(k).alias(f"_hot_{i}") for i, k in enumerate(keys)]
    hot = df.groupBy(*named).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > chunk_rows)
    hot = stored(hot, "hot-keys")
    rows = hot.agg(F.sum("_rows")).first()[0]
    if rows is None:
        return df.withColumn(CHUNK, F.lit(0)), False
    # Null-safe: rows without a key form one sequence.
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_hot_{i}")) for i, k in enumerate(keys)])
    order = [*keys, *order_by]
    cut = df.join(hot.drop("_rows"), same, "left_semi").repartitionByRange(
        int(-(-rows // chunk_rows)) + 1, *order).withColumn(CHUNK, F.spark_partition_id() + 1)
    rest = df.join(hot.drop("_rows"), same, "left_anti").withColumn(CHUNK, F.lit(0))
    return rest.unionByName(stored(cut, "hot-rows")), True


def adjacent(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], value: Column, name: str,
             ahead: bool = False, unit: str | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add ``name``: ``value`` of the previous row (the next one if ``ahead``) of the same keys.

    ``order_by`` must be a total order per key; with a ``unit`` its first column is the time that chunks are cut by.
    """
    cut, several = chunked(df, keys, order_by, unit, chunk_rows)
    return adjacent_in_chunks(cut, several, keys, order_by, value, name, ahead).drop(CHUNK)


def adjacent_in_chunks(df: DataFrame, several: bool, keys: Sequence[str], order_by: Sequence[str], value: Column,
                       name: str, ahead: bool = False) -> DataFrame:
    """As :func:`adjacent` for rows that :func:`chunked` has marked (or some of them); the mark stays."""
    near, far = (F.lead, F.lag) if ahead else (F.lag, F.lead)
    inside = Window.partitionBy(*keys, CHUNK).orderBy(*order_by)
    across = Window.partitionBy(*keys).orderBy(*order_by)
    if not several:
        return df.withColumn(name, near(value).over(across))
    # Held in a struct, so that a NULL value is not taken for a missing neighbour.
    df = df.withColumn("_value", F.struct(value.alias("v")))
    rows = df.withColumns({"_near": near("_value").over(inside), "_far": far("_value").over(inside)})
    # Rows without a near neighbour begin their chunk; the one they lack ends the chunk before. Among the first and
    # last rows of all chunks it is the neighbour. Both branches read the same shuffle.
    ends = rows.filter(F.col("_near").isNull() | F.col("_far").isNull())
    begins = ends.withColumn("_over", near("_value").over(across)).filter(F.col("_near").isNull())
    begins = begins.withColumn("_near", F.col("_over")).drop("_over")
    found = rows.filter(F.col("_near").isNotNull()).unionByName(begins)
    return found.withColumn(name, F.col("_near.v")).drop("_value", "_near", "_far")


def last_known(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], value: Column, name: str,
               unit: str | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add ``name``: the latest non-NULL ``value`` up to and including each row of the same keys."""
    df, several = chunked(df, keys, order_by, unit, chunk_rows)
    # The key columns in one struct: it is never NULL, so NULL keys form a group like any other, and the windows, the
    # summaries and the join between them hash alike. The long side is shuffled and sorted once.
    group = ["_key", CHUNK]
    df = df.withColumns({"_key": F.struct(*keys), "_value": value})
    inside = Window.partitionBy(*group).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = df.withColumn("_near", F.last("_value", ignorenulls=True).over(inside))
    if not several:
        return rows.withColumn(name, F.col("_near")).drop(*group, "_value", "_near")
    across = Window.partitionBy("_key").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    # All chunks by a plain distinct; only the rows that have a value are compared by order.
    latest = df.filter(F.col("_value").isNotNull()).groupBy(*group).agg(
        F.max_by("_value", F.struct(*order_by)).alias("_edge"))
    chunks = df.select(*group).distinct().join(latest, group, "left")
    carried = chunks.select(*group, F.last("_edge", ignorenulls=True).over(across).alias("_carry"))
    joined = rows.join(carried, group, "left")
    return joined.withColumn(name, F.coalesce("_near", "_carry")).drop(*group, "_value", "_near", "_carry")
