"""Type-2 history as a stored table that batches of changes are merged into.

The table ``<name>`` holds the versions, ``<name>_changes`` every different change they come from. Both are partitioned by a
hash bucket of the keys and a slice of time (``slice_days``; of a version: where it starts).

A batch alters the history around its changes only. A new change lies between two stored versions of its key, or before the
first, or after the last; it can end the one before it, and what it repeats or interrupts shows at the latest with the one
after it. These neighbours are found by the order of versions and new changes, both without their payload; neighbours that
follow each other form a segment. The changes of the segments, and no others, are read again, versions are made of them and
of the batch, and the last one of a segment ends where the next, untouched version starts. Only the partitions that lose
or gain a version are written. So the table equals a full rebuild from all changes, whatever the order they came in.

The changes are appended once the versions are written. A driver lost before that leaves a table that a replay of the
batch brings to its end, from whichever partitions were swapped already; a replay afterwards finds nothing new and
touches nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType

from strata.operators import history
from strata.operators.adjacent import CHUNK, adjacent_in_chunks, chunked, last_known
from strata.operators.history import END, START
from strata.session import stored
from strata.sources import tables
from strata.sources.tables import PART, RUN

SLICE_DAYS = 30


def changes_of(table: str) -> str:
    return f"{table}_changes"


def merge(spark: SparkSession, changes: DataFrame, table: str, keys: Sequence[str], tracked: Sequence[str],
          order_by: Sequence[str], buckets: int = tables.DEFAULT_BUCKETS, unit: str | None = None,
          slice_days: int = SLICE_DAYS) -> None:
    """Bring a batch of changes into the history (arguments as for :func:`strata.operators.history.scd2`).

    Rows whose keys are NULL share one history. Equal rows count once. Times of changes are not NULL. ``buckets`` counts
    when the table is created; ``slice_days`` may differ between batches.
    """
    feed, columns = changes_of(table), list(dict.fromkeys((*keys, *tracked, *order_by)))
    rows = changes.select(*columns)
    tables.ensure_merge_table(spark, rows.withColumn(PART, F.lit(0).cast("long")), feed, buckets)
    buckets = tables.bucket_count(spark, feed)
    # Placed by the table's types, which a later batch may differ from.
    rows = tables.aligned(spark, rows.withColumn(PART, F.lit(0).cast("long")), feed).select(*columns)
    time = order_by[0]
    rows = stored(rows.withColumn(PART, _place(keys, time, rows.schema[time].dataType, buckets, slice_days)), "batch")
    shape = history.scd2(rows.drop(PART).limit(0), keys, tracked, order_by, "day").withColumn(PART, F.lit(0).cast("long"))
    tables.ensure_merge_table(spark, shape, table, buckets)
    parts = [row[0] for row in rows.select(PART).distinct().collect()]
    touched = {part % RUN for part in parts}
    # Equal changes have one place, or lie in the first slice of a table from before there were slices.
    known = _rows(spark, feed, (p for p in tables._parts(spark, feed) if p in parts or p in touched))
    fresh = stored(rows.drop(PART).subtract(known.select(*columns)), "fresh")
    since = fresh.agg(F.min(time)).first()[0]
    if since is None:
        return
    near = stored(neighbours(spark, fresh, table, keys, order_by, touched, since, unit), "neighbours")
    used = segment_changes(spark, fresh, near, feed, keys, columns, order_by, touched, unit)
    versions = history.scd2(used, [*keys, "_segment", "_stop"], tracked, order_by, unit)
    versions = versions.withColumn(END, F.coalesce(END, F.col("_stop")[time])).drop("_segment", "_stop")
    start_type = versions.schema[START].dataType
    versions = stored(versions.withColumn(PART, _place(keys, START, start_type, buckets, slice_days)), "versions")
    gone = near.filter("_version").select(*_position(keys, order_by), "_at")
    rewritten = {row[0] for row in gone.select("_at").union(versions.select(PART)).distinct().collect()}
    kept = _rows(spark, table, rewritten).withColumn("_time", F.col(START)).alias("v").join(
        gone.alias("g"), reduce(and_, [
            F.col(f"v.{'_time' if c == time else c}").eqNullSafe(F.col(f"g.{c}")) for c in _position(keys, order_by)]),
        "left_anti").drop("_time")
    merged = tables.aligned(spark, kept.unionByName(versions), table)
    before = set(tables._parts(spark, table))
    written = tables.overwrite_parts(spark, merged.hint("rebalance", F.col(PART)), table)
    for part in sorted((rewritten & before) - written):
        spark.sql(f"ALTER TABLE {tables._name(table)} DROP PARTITION ({PART}={part})")
    placed = fresh.withColumn(PART, _place(keys, time, fresh.schema[time].dataType, buckets, slice_days))
    tables.append(spark, placed.hint("rebalance", F.col(PART)), feed)


def _place(keys: Sequence[str], time: str, kind: DataType, buckets: int, slice_days: int) -> Column:
    """The layout value: bucket of the keys and slice of the time. Times that are no dates have one slice."""
    bucket = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("long")
    if isinstance(kind, TimestampType):
        day = F.floor(F.unix_seconds(F.col(time)) / 86400)
    elif isinstance(kind, (DateType, TimestampNTZType)):
        day = F.unix_date(F.col(time).cast("date"))
    else:
        return bucket
    return bucket + F.coalesce(F.floor(day / slice_days), F.lit(0)).cast("long") * RUN


def _rows(spark: SparkSession, table: str, parts: Iterable[int]) -> DataFrame:
    spark.catalog.refreshTable(table)
    wanted = sorted(parts)
    return spark.read.table(table).filter(F.col(PART).isin(wanted) if wanted else F.lit(False))


def _position(keys: Sequence[str], order_by: Sequence[str]) -> list[str]:
    return [*dict.fromkeys((*keys, *order_by))]


def _same(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)])


def _of_keys(rows: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.join(wanted.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)]).distinct(), _same(keys),
                     "left_semi")


def neighbours(spark: SparkSession, fresh: DataFrame, table: str, keys: Sequence[str], order_by: Sequence[str],
               touched: set[int], since, unit: str | None = None) -> DataFrame:
    """Keys and order of the new changes and of the stored versions next to them (``_version``, in partition ``_at``).

    ``_segment`` is the last untouched version before a row; ``_next`` the row that follows. Versions that ended before
    the first new change are not read, the others without what they track.
    """
    time, place = order_by[0], _position(keys, order_by)
    versions = _rows(spark, table, (p for p in tables._parts(spark, table) if p % RUN in touched))
    versions = versions.filter(F.col(END).isNull() | (F.col(END) >= F.lit(since)))
    held = _of_keys(versions, fresh, keys).select(
        *[F.col(START).alias(c) if c == time else F.col(c) for c in place],
        F.lit(False).alias("_new"), F.lit(True).alias("_version"), F.col(PART).alias("_at"))
    added = fresh.select(*place, F.lit(True).alias("_new"), F.lit(False).alias("_version"),
                         F.lit(None).cast("long").alias("_at"))
    # A version that an earlier try of this batch wrote stands at its change's place.
    seen = held.unionByName(added).groupBy(*place).agg(*[F.max(c).alias(c) for c in ("_new", "_version", "_at")])
    cut, several = chunked(seen, keys, order_by, unit)
    for name, ahead in (("_before", False), ("_after", True)):
        cut = adjacent_in_chunks(cut, several, keys, order_by, F.col("_new"), name, ahead)
    near = F.col("_new") | F.coalesce("_before", F.lit(False)) | F.coalesce("_after", F.lit(False))
    cut = cut.withColumn("_hit", near).drop("_before", "_after")
    cut = adjacent_in_chunks(cut, several, keys, order_by, F.struct("_hit", *order_by), "_next", ahead=True).drop(CHUNK)
    untouched = F.when(~F.col("_hit"), F.struct(*order_by))
    return last_known(cut, keys, order_by, untouched, "_segment", unit).filter("_hit")


def segment_changes(spark: SparkSession, fresh: DataFrame, near: DataFrame, feed: str, keys: Sequence[str],
                    columns: Sequence[str], order_by: Sequence[str], touched: set[int],
                    unit: str | None = None) -> DataFrame:
    """The new changes and the stored ones in their segments, with ``_segment`` and ``_stop``, where the segment ends.

    Changes and beginnings of segments are merged in order, so the work is linear in both.
    """
    time = order_by[0]
    stop = F.when(~F.col("_next._hit"), F.struct(*[F.col(f"_next.{c}").alias(c) for c in order_by]))
    spans = stored(near.groupBy(*keys, "_segment").agg(
        F.min(F.struct(*order_by)).alias("_first"), F.max(stop).alias("_stop")), "segments")
    first = spans.agg(F.min(F.col("_first")[time])).first()[0]
    past = _rows(spark, feed, (p for p in tables._parts(spark, feed) if p % RUN in touched))
    past = _of_keys(past.filter(F.col(time) >= F.lit(first)), fresh, keys).select(*columns)
    rows = past.unionByName(fresh.select(*columns)).distinct().withColumn("_kind", F.lit(1))
    begins = spans.select(*keys, *[F.col("_first")[c].alias(c) for c in order_by if c not in keys],
                          F.lit(0).alias("_kind"), F.struct("_segment", "_stop").alias("_span"))
    merged = rows.unionByName(begins, allowMissingColumns=True)
    filled = last_known(merged, keys, [*order_by, "_kind"], F.col("_span"), "_in", unit)
    inside = F.col("_in._stop").isNull() | (F.struct(*order_by) < F.col("_in._stop"))
    return filled.filter((F.col("_kind") == 1) & F.col("_in").isNotNull() & inside).select(
        *columns, F.col("_in._segment").alias("_segment"), F.col("_in._stop").alias("_stop"))
