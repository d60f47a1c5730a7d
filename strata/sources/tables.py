"""Catalog tables on plain Parquet: append, upsert, full refresh, additive schema evolution, clustered layout.

Tables that batches are merged into carry one layout column, ``_part``. Rows with a key lie in a hash bucket of that
key, and a bucket in runs of bounded size, each a partition of its own: new keys fill the bucket's last run and then begin
others, by ranges of the key. An upsert looks its keys up among the keys of the buckets they fall into, and rewrites only
the runs that hold one of them, and the last ones. Rows without a key lie in a partition of their own writer and batch. Either way the partitions of a replayed batch are overwritten by the same content, so a replay adds
nothing. (Batch numbers belong to a stream's checkpoint: drop the table together with the checkpoint.)

A batch writes its partitions to a folder of its own below the table and then points the table at them, one partition
after another. The files that a partition had before stay until it is written again, so a driver lost at any moment
loses no row, and replaying its batch completes the merge.
"""

from __future__ import annotations

import json
import re
import time
import uuid
import zlib
from collections.abc import Callable, Container, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, DataType, DateType, DecimalType, MapType, NullType, StringType, StructType, TimestampNTZType)

from strata.operators import merge
from strata.session import stored

PART = "_part"
BUCKETS_PROPERTY = "strata.buckets"
BASE_PROPERTY = "strata.buckets.base"
GROWING_PROPERTY = "strata.buckets.growing"
FOLDED_PROPERTY = "strata.folded"
FOLDING_PROPERTY = "strata.folding"
REPLAY_PROPERTY = "strata.replay"
DEFAULT_BUCKETS = 64
# A layout value is a bucket, below this number, and as often this number as the bucket has runs before it.
RUN = 1 << 20
# Rows of a run. A run is written whole, so this bounds what an upsert rewrites for one key.
RUN_ROWS = 1_000_000
# Versions of a partition or of a refreshed table that are kept: the current one, and the one that readers who began
# before the last write may still be reading.
KEPT_VERSIONS = 2
# Calls of the catalog or the file system at a time, and new partitions in one of them.
CALLS, PER_CALL = 8, 100


def ensure_schema(spark: SparkSession, table: str) -> None:
    """Create the schema of a two-part table name."""
    if "." in table:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_name(table.rsplit('.', 1)[0])}")


def exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def read(spark: SparkSession, table: str) -> DataFrame:
    """The table without its layout column, as of now: streams write in a session of their own, so a file listing
    that this session holds may be out of date."""
    spark.catalog.refreshTable(table)
    return spark.read.table(table).drop(PART)


def drop(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_name(table)}")


def drop_view(spark: SparkSession, view: str) -> None:
    spark.sql(f"DROP VIEW IF EXISTS {_name(view)}")


def evolve(spark: SparkSession, schema: StructType, table: str) -> StructType:
    """Add the columns that a table lacks (a catalog change only: no file is rewritten); returns the table's schema."""
    spark.catalog.refreshTable(table)
    known = {c.lower() for c in spark.table(table).columns}
    new = StructType([f for f in schema.fields if f.name.lower() not in known])
    if new.fields:
        spark.sql(f"ALTER TABLE {_name(table)} ADD COLUMNS ({_ddl(new)})")
    return spark.table(table).schema


def append(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Append rows; new columns are added to the table, missing ones are NULL. Existing files are not touched."""
    ensure_schema(spark, table)
    if not exists(spark, table):
        _create(spark, table, df.schema)
    aligned(spark, df, table).write.insertInto(table)


def append_batch(spark: SparkSession, df: DataFrame, table: str, batch_id: int, writer: str = "",
                 rebalance: bool = False, cluster_by: Sequence[str] = ()) -> None:
    """Append the rows of one batch; a replay of the batch replaces them. ``writer`` tells apart the jobs that share
    a table, as each counts its own batches. Every task writes its rows where they are, unless ``rebalance`` asks
    for evenly sized files or ``cluster_by`` for ranges of some columns. :func:`fold` brings old batches together."""
    df = df.withColumn(PART, F.lit(batch_part(batch_id, writer)).cast("long"))
    ensure_merge_table(spark, df, table)
    _finish_folding(spark, table)
    if _is_folded(spark, table, batch_id, writer):
        return
    rows = aligned(spark, df, table)
    if cluster_by:
        rows = clustered(rows, cluster_by)
    elif rebalance:
        rows = rows.hint("rebalance")
    overwrite_parts(spark, rows, table)


def upsert(spark: SparkSession, df: DataFrame, table: str, key: str, batch_id: int = 0,
           order_by: Sequence[str] = (), buckets: int = DEFAULT_BUCKETS, writer: str = "",
           cluster_by: Sequence[str] = (), ties: str = "source", run_rows: int = RUN_ROWS) -> None:
    """Merge a batch into a table by key (see :func:`strata.operators.merge.upsert`).

    ``buckets`` counts when the table is created; :func:`grow` raises it later. With ``cluster_by`` each run's files hold
    ranges of those columns.
    """
    ensure_merge_table(spark, df.withColumn(PART, F.lit(0).cast("long")), table, buckets)
    _finish_growth(spark, table, key)
    _finish_folding(spark, table)
    loose = df.filter(F.lit(False) if _is_folded(spark, table, batch_id, writer) else F.col(key).isNull())
    known = spark.table(table).columns
    loose = aligned(spark, loose.withColumn(PART, F.lit(batch_part(batch_id, writer)).cast("long")), table)
    kinds = {f.name.lower(): f for f in loose.schema.fields}
    given = [F.col(c).cast(kinds[c.lower()].dataType).alias(kinds[c.lower()].name) for c in df.columns]
    latest = merge.latest_per_key(df.filter(F.col(key).isNotNull()), key, order_by).select(*given)
    latest = latest.withColumn(PART, _bucket(key, *bucket_counts(spark, table)).cast("long"))
    # Computed once: the steps below ask for its keys, its buckets and its rows.
    latest = stored(latest, "latest")
    arriving = {r[0]: r[1] for r in latest.groupBy(PART).count().collect()}
    held = {int(p): (rows, hits) for p, rows, hits in _hits(spark, table, latest, key, arriving)}
    last: dict[int, int] = {}
    for part, (_, hits) in held.items():
        arriving[part % RUN] -= hits
        last[part % RUN] = max(part, last.get(part % RUN, part))
    # Of the buckets that get new keys: the last run, if these fit in.
    room = {b: last[b] for b, n in arriving.items() if b in last and n and held[last[b]][0] + n <= run_rows}
    rewritten = sorted({p for p, (_, hits) in held.items() if hits} | set(room.values()))
    # Not refreshed again: the files were listed for the keys.
    target = _packed(spark.read.table(table).filter(_among(rewritten)), len(rewritten))
    # The pieces, and about how many runs and rows each has.
    pieces, new = [], {b: n for b, n in arriving.items() if n and b not in room}
    if rewritten:
        order = merge.order_of(target.select(*known), latest, key, order_by, ties)
        rows = sum(held[p][0] for p in rewritten) + sum(arriving[b] for b in room)
        pieces.append((_settled(target, latest, key, order, room), len(rewritten), rows))
    if new:
        begun = latest.filter(_among(sorted(new)))
        if rewritten:
            begun = begun.join(target.select(key).hint("merge"), key, "left_anti")
        ranges = max(1, -(-sum(new.values()) // run_rows))
        begun = begun.repartitionByRange(ranges, PART, key)
        first = max(held, default=-1) // RUN + 1
        begun = begun.withColumn(PART, F.col(PART) + (F.spark_partition_id().cast("long") + first) * RUN)
        lacking = [F.lit(None).cast(f.dataType).alias(f.name) for f in kinds.values() if f.name not in begun.columns]
        pieces.append((begun.select("*", *lacking), ranges + len(new), sum(new.values())))
    if cluster_by:
        merged = clustered(reduce(merge.append_evolved, [p for p, _, _ in pieces], loose), [PART, *cluster_by])
    else:
        # Rows without a key may be many, and all lie in one partition.
        merged = reduce(merge.append_evolved, [by_run(*p) for p in pieces], loose.hint("rebalance", F.col(PART)))
    overwrite_parts(spark, merged.select(loose.columns), table)


def _settled(target: DataFrame, latest: DataFrame, key: str, order: Sequence[str], room: dict[int, int]) -> DataFrame:
    """The rows of rewritten runs after a batch: those it leaves alone, those it replaces, and the new keys that find room.

    One join of either side with the other, by sort and merge, as both grow with the input. A source row takes the target
    row's place unless that is later by ``order``; columns that the source lacks keep the target's value.
    """
    was = {c: f"_was_{i}" for i, c in enumerate(target.columns)}
    now = {c: f"_now_{i}" for i, c in enumerate(latest.columns) if c != PART}
    # A row per bucket.
    open_runs = latest.sparkSession.createDataFrame([*room.items()], f"{PART} long, _room long")
    new = latest.join(F.broadcast(open_runs), PART, "left").select(
        F.col(key).alias("_key"), "_room", F.struct(F.lit(0), *order).alias("_new"), *[F.col(c).alias(n) for c, n in now.items()])
    old = target.select(F.col(key).alias("_old_key"), F.struct(F.lit(0), *order).alias("_have"),
                        *[F.col(c).alias(n) for c, n in was.items()])
    both = old.join(new.hint("merge"), F.col("_old_key") == F.col("_key"), "full")
    both = both.filter(F.col(was[PART]).isNotNull() | F.col("_room").isNotNull())
    stays = F.col("_key").isNull() | F.coalesce(F.col("_have") > F.col("_new"), F.lit(False))
    return both.select(*[
        F.coalesce(n, "_room").alias(c) if c == PART
        else F.when(stays, F.col(n)).otherwise(F.col(now[c])).alias(c) if c in now else F.col(n).alias(c)
        for c, n in was.items()])


def _among(parts: Sequence[int]) -> Column:
    """Whether the layout value is one of these. As one text: literals would each be a call of the JVM."""
    return F.expr(f"{PART} IN ({', '.join(f'{p}L' for p in parts)})") if parts else F.lit(False)


# Small runs that one task writes, and rows from which a run is not small.
RUNS_PER_TASK, SMALL_RUN = 16, 10_000


def by_run(df: DataFrame, runs: int, rows: int) -> DataFrame:
    """The rows of about so many runs brought together by run. AQE joins small runs and splits large ones by their bytes;
    many small runs, which would all end in one task that writes a file for each, are dealt to tasks by their number."""
    if runs <= RUNS_PER_TASK or rows > SMALL_RUN * runs:
        return df.hint("rebalance", F.col(PART))
    return df.repartition(-(-runs // RUNS_PER_TASK), PART)


# Bytes and runs that one task reads at least, where there are more tasks than cores.
READ_BYTES, READ_RUNS = 32 << 20, 128


def _packed(stored_rows: DataFrame, runs: int) -> DataFrame:
    """A scan of so many runs in fewer tasks, if these are small: each task opens a file for every reducer of the shuffle
    that follows, which costs far more than a few hundred rows. The tasks together read what they would read."""
    size = int(str(stored_rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    tasks = max(stored_rows.sparkSession.sparkContext.defaultParallelism, size // READ_BYTES, runs // READ_RUNS)
    # A scan of unknown size counts as huge, and stays as it is.
    return stored_rows.coalesce(min(tasks, 1 << 20))


def _hits(spark: SparkSession, table: str, latest: DataFrame, key: str, buckets: Container[int]) -> list:
    """Layout value, rows and touched rows of each run of the buckets that the keys fall into. Reads keys only."""
    parts = [p for p in _parts(spark, table) if p >= 0 and p % RUN in buckets]
    if not parts:
        return []
    spark.catalog.refreshTable(table)
    keys = _packed(spark.read.table(table).filter(_among(parts)).select(F.col(PART).alias("_at"), key), len(parts))
    return _hit_counts(keys, latest, key).collect()


def _hit_counts(keys: DataFrame, latest: DataFrame, key: str) -> DataFrame:
    """``_at``, rows and touched rows of each run. By sort and merge: the keys of a batch are not broadcast."""
    seen = keys.join(latest.select(key, F.lit(1).alias("_hit")).hint("merge"), key, "left")
    return seen.groupBy("_at").agg(F.count("*"), F.count("_hit"))


def _drop_parts(spark: SparkSession, table: str, parts: Sequence[int]) -> None:
    if parts:
        gone = ", ".join(f"PARTITION ({PART}={p})" for p in parts)
        spark.sql(f"ALTER TABLE {_name(table)} DROP IF EXISTS {gone}")


def _parts(spark: SparkSession, table: str) -> list[int]:
    return [int(row[0].split("=")[1]) for row in spark.sql(f"SHOW PARTITIONS {_name(table)}").collect()]


def _bucket(key: str, buckets: int, base: int) -> Column:
    """Linear hashing: with ``base`` times a power of two buckets, some of them split already, an address is taken modulo
    twice that number, and modulo the number itself where that bucket is not there yet."""
    value = F.xxhash64(F.col(key).cast("string"))
    whole = _level(buckets, base)
    wide = F.pmod(value, F.lit(2 * whole))
    return F.when(wide < buckets, wide).otherwise(F.pmod(value, F.lit(whole)))


def _level(buckets: int, base: int) -> int:
    while 2 * base <= buckets:
        base *= 2
    return base


def grow(spark: SparkSession, table: str, key: str, buckets: int) -> None:
    """Raise the number of buckets of a merge table: the buckets that the new ones split off from are divided, others
    stay as they are. A driver lost amid it leaves a table that the next upsert, or another call, brings to its end;
    until then rows of a divided bucket may show twice."""
    _finish_growth(spark, table, key)
    have, base = bucket_counts(spark, table)
    if not have <= buckets < RUN:
        raise ValueError(f"a table of {have} buckets cannot be brought to {buckets}")
    spark.sql(f"ALTER TABLE {_name(table)} SET TBLPROPERTIES ('{BASE_PROPERTY}' = '{base}', "
              f"'{GROWING_PROPERTY}' = '{buckets}')")
    _finish_growth(spark, table, key)


def _finish_growth(spark: SparkSession, table: str, key: str) -> None:
    wanted = _properties(spark, table).get(GROWING_PROPERTY)
    if wanted is None:
        return
    wanted, (have, base) = int(wanted), bucket_counts(spark, table)
    divided = set()
    for bucket in range(have, wanted):
        divided.add(bucket)
        while bucket >= have:
            bucket -= _level(bucket, base)
        divided.add(bucket)
    parts = [p for p in _parts(spark, table) if p >= 0 and p % RUN in divided]
    if parts:
        spark.catalog.refreshTable(table)
        old = _packed(spark.read.table(table).filter(_among(parts)), len(parts))
        run = F.col(PART) - F.pmod(PART, F.lit(RUN))
        rows = old.dropDuplicates([key]).withColumn(PART, run + _bucket(key, wanted, base)).select(old.columns)
        runs = len(parts) * -(-wanted // have)
        # Counts come from the files' footers.
        written = overwrite_parts(spark, by_run(rows, runs, old.count() if runs > RUNS_PER_TASK else 0), table)
        _drop_parts(spark, table, sorted(set(parts) - written))
    spark.sql(f"ALTER TABLE {_name(table)} SET TBLPROPERTIES ('{BUCKETS_PROPERTY}' = '{wanted}')")
    spark.sql(f"ALTER TABLE {_name(table)} UNSET TBLPROPERTIES ('{GROWING_PROPERTY}')")


def touched_rows(spark: SparkSession, table: str, batch: DataFrame) -> DataFrame:
    """The table's rows in the partitions that the rows of a batch fall into."""
    # At most `buckets` numbers: they prune the scan of the target to the partitions that change.
    touched = [row[0] for row in batch.select(PART).distinct().collect()]
    spark.catalog.refreshTable(table)
    return spark.read.table(table).filter(F.col(PART).isin(touched) if touched else F.lit(False))


def batch_part(batch_id: int, writer: str = "") -> int:
    """The layout value of keyless rows: negative, one per writer and batch."""
    return -1 - batch_id - (zlib.crc32(writer.encode()) << 31)


def fold(spark: SparkSession, table: str, writer: str = "", rows: int = RUN_ROWS, keep: int = 1) -> int:
    """Bring the partitions of a writer's batches together, in order, about ``rows`` rows to each; the newest ``keep``
    batches stay as they are. Returns how many partitions there are fewer.

    The table remembers which batches it has folded: their replay adds nothing. The new files are written beside the old
    ones and then take their place; a driver lost amid that leaves a table that the next append, upsert or fold brings
    to its end (rows of a folded batch may show twice until then). Nothing is folded amid a replay of the writer.
    """
    _finish_folding(spark, table)
    if writer in _replays(spark, table):
        return 0
    numbers = sorted(n for p in _parts(spark, table) if (n := _batch_of(p, writer)) is not None)
    numbers = numbers[:max(0, len(numbers) - keep)]
    if len(numbers) < 2:
        return 0
    parts = [batch_part(n, writer) for n in numbers]
    spark.catalog.refreshTable(table)
    old = spark.read.table(table).filter(F.col(PART).isin(parts))
    sizes = {row[0]: row[1] for row in old.groupBy(PART).count().collect()}
    bins, held = [[numbers[0]]], sizes.get(parts[0], 0)
    for number, part in zip(numbers[1:], parts[1:]):
        if held + sizes.get(part, 0) > rows:
            bins.append([])
            held = 0
        bins[-1].append(number)
        held += sizes.get(part, 0)
    bins = [b for b in bins if len(b) > 1]
    if not bins:
        return 0
    # A row per partition of the table: its size is bounded by what the catalog lists anyway.
    targets = spark.createDataFrame(
        [(batch_part(n, writer), batch_part(b[0], writer)) for b in bins for n in b], f"{PART} long, _target long")
    moved = old.join(F.broadcast(targets), PART).withColumn(PART, F.col("_target")).select(old.columns)
    folder = f"{_location(spark, table).rstrip('/')}/_batches/{_stamp()}"
    moved.hint("rebalance", F.col(PART)).write.partitionBy(PART).parquet(folder)
    plan = {"folder": folder, "writer": writer, "bins": [f"{b[0]}-{b[-1]}" for b in bins]}
    _set_property(spark, table, FOLDING_PROPERTY, json.dumps(plan))
    return _finish_folding(spark, table)


def _finish_folding(spark: SparkSession, table: str) -> int:
    """Let the written partitions of a fold take the old ones' place. Each step may have been done before."""
    text = _properties(spark, table).get(FOLDING_PROPERTY)
    if text is None:
        return 0
    plan = json.loads(text)
    writer, gone = plan["writer"], 0
    have = {n: p for p in _parts(spark, table) if (n := _batch_of(p, writer)) is not None}
    for first, last in (map(int, b.split("-")) for b in plan["bins"]):
        target = f"{PART}={batch_part(first, writer)}"
        spark.sql(f"ALTER TABLE {_name(table)} PARTITION ({target}) SET LOCATION '{plan['folder']}/{target}'")
        for number in (n for n in have if first < n <= last):
            spark.sql(f"ALTER TABLE {_name(table)} DROP IF EXISTS PARTITION ({PART}={have[number]})")
            gone += 1
    folded = _folded(spark, table)
    folded.setdefault(writer, []).extend(plan["bins"])
    _set_property(spark, table, FOLDED_PROPERTY, json.dumps({w: _united(r) for w, r in folded.items()}))
    spark.sql(f"ALTER TABLE {_name(table)} UNSET TBLPROPERTIES ('{FOLDING_PROPERTY}')")
    spark.catalog.refreshTable(table)
    return gone


def _united(ranges: Sequence[str]) -> list[str]:
    """Ranges of batch numbers, those that overlap as one."""
    out: list[list[int]] = []
    for first, last in sorted(tuple(map(int, r.split("-"))) for r in ranges):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [f"{a}-{b}" for a, b in out]


def _folded(spark: SparkSession, table: str) -> dict[str, list[str]]:
    return json.loads(_properties(spark, table).get(FOLDED_PROPERTY, "{}"))


def _is_folded(spark: SparkSession, table: str, batch_id: int, writer: str) -> bool:
    ranges = (map(int, r.split("-")) for r in _folded(spark, table).get(writer, []))
    return any(first <= batch_id <= last for first, last in ranges)


def _batch_of(part: int, writer: str) -> int | None:
    """The batch whose layout value this is, if it is one of this writer's."""
    number = -1 - part - (zlib.crc32(writer.encode()) << 31)
    return number if part < 0 and 0 <= number < 1 << 31 else None


def begin_replay(spark: SparkSession, table: str, writer: str = "") -> None:
    """Note that a writer, whose checkpoint is new, writes all its batches again, cut in whatever way. What it wrote before
    stays until :func:`end_replay`; batches that were folded are written again too. Another call begins anew."""
    if not exists(spark, table) or all(_batch_of(p, writer) is None for p in _parts(spark, table)):
        return
    _finish_folding(spark, table)
    _set_property(spark, table, REPLAY_PROPERTY, json.dumps({**_replays(spark, table), writer: _stamp()}))
    folded = _folded(spark, table)
    if folded.pop(writer, None):
        _set_property(spark, table, FOLDED_PROPERTY, json.dumps(folded))


def end_replay(spark: SparkSession, table: str, writer: str = "") -> None:
    """Drop the batch partitions that the writer's replay has not written: their rows are in others now. A driver lost
    before this leaves rows that show twice until the writer's next run ends the replay."""
    begun = _replays(spark, table) if exists(spark, table) else {}
    since = begun.pop(writer, None)
    if since is None:
        return
    again = {part for stamp, part in _batch_folders(spark, f"{_location(spark, table).rstrip('/')}/_batches") if stamp > since}
    _drop_parts(spark, table, [p for p in _parts(spark, table)
                               if _batch_of(p, writer) is not None and f"{PART}={p}" not in again])
    _set_property(spark, table, REPLAY_PROPERTY, json.dumps(begun))
    spark.catalog.refreshTable(table)


def _replays(spark: SparkSession, table: str) -> dict[str, str]:
    """When the writers whose replay has not ended began it."""
    return json.loads(_properties(spark, table).get(REPLAY_PROPERTY, "{}"))


def _set_property(spark: SparkSession, table: str, name: str, value: str) -> None:
    text = value.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {_name(table)} SET TBLPROPERTIES ('{name}' = '{text}')")


def replace(spark: SparkSession, df: DataFrame, table: str, cluster_by: Sequence[str] = (),
            sort_by: str | Sequence[str] = (), location: str | None = None, interleave: bool = False) -> None:
    """Full refresh: write a new version beside the old one, then point the table at it.

    Readers see the old or the new version, never a half-written one, and a failed job leaves the old one in place.
    (A table whose columns change, or that was managed, is dropped and created anew: readers can miss it in between.)
    The last ``KEPT_VERSIONS`` versions stay on disk. ``cluster_by`` lays the files out by those columns, and an order
    of the result is then left to the query; without it a frame that is already sorted (``sort_by``) keeps its order.
    """
    ensure_schema(spark, table)
    root = location or _default_location(spark, table)
    versions = f"{root.rstrip('/')}.versions"
    version = f"{versions}/{_stamp()}"
    if cluster_by:
        laid_out = clustered(df, cluster_by, interleave)
    else:
        laid_out = df if sort_by else df.hint("rebalance")
    laid_out.write.parquet(version)
    if exists(spark, table):
        if _columns(spark.table(table).schema) == _columns(df.schema) and _is_external(spark, table):
            spark.sql(f"ALTER TABLE {_name(table)} SET LOCATION '{version}'")
            spark.catalog.refreshTable(table)
            _retire(spark, f"{versions}/*")
            return
        drop(spark, table)
    _create(spark, table, df.schema, location=version)


def clustered(df: DataFrame, columns: Sequence[str], interleave: bool = False) -> DataFrame:
    """Range-partition and sort by the columns, so that Parquet min/max statistics skip files and row groups.

    By default the columns count in the order given, which serves filters on the first one best. With ``interleave``
    all of them count alike (a Z-order over quantile ranks; one more pass over ``df`` finds the quantiles). A row
    hash ends the range key: a value that holds a large share of the rows is spread over many files.
    """
    spread = F.xxhash64(*[F.col(f.name) for f in df.schema.fields if merge.orderable(f.dataType)])
    if not interleave or len(columns) == 1:
        return df.repartitionByRange(*columns, spread).sortWithinPartitions(*columns)
    ranked = df.withColumn("_z", _z_value(df, columns))
    return ranked.repartitionByRange("_z", *columns, spread).sortWithinPartitions("_z", *columns).drop("_z")


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], interleave: bool = False) -> None:
    clustered(df, columns, interleave).write.mode("overwrite").parquet(path)


RANK_BITS = 5
# Rows from which the quantiles of text columns are taken; only layout depends on them.
RANK_SAMPLE = 10_000


def _z_value(df: DataFrame, columns: Sequence[str]) -> Column:
    """Interleaved bits of each column's quantile rank (0 to 31).

    Numbers and times are ranked by approximate quantiles, texts by the quantiles of a sample. The bounds of texts are
    beginnings of 1,000 characters, which whole texts are compared with; only the layout depends on them.
    """
    if RANK_BITS * len(columns) > 63:
        raise ValueError(f"at most {63 // RANK_BITS} columns can be interleaved")
    texts = [c for c in columns if isinstance(df.schema[c].dataType, StringType)]
    values = [F.col(c) if c in texts else _as_number(df, c) for c in columns]
    cuts = [i / 2 ** RANK_BITS for i in range(1, 2 ** RANK_BITS)]
    # One row of 31 numbers per column.
    numbers = [v if c not in texts else F.lit(0.0) for c, v in zip(columns, values)]
    first = df.agg(F.count("*").alias("rows"), *[
        F.percentile_approx(n, cuts, 2000).alias(f"_{i}") for i, n in enumerate(numbers)]).first()
    bounds = {c: first[f"_{i}"] or [] for i, c in enumerate(columns)}
    if texts:
        share = min(1.0, RANK_SAMPLE / max(first["rows"], 1))
        sample = df.select(*[F.substring(c, 1, 1000).alias(c) for c in texts]).sample(fraction=share, seed=5).limit(
            2 * RANK_SAMPLE).collect()
        for c in texts:
            seen = sorted(row[c] for row in sample if row[c] is not None)
            bounds[c] = [seen[int(cut * len(seen))] for cut in cuts] if seen else []
    z = F.lit(0).cast("long")
    for i, (column, value) in enumerate(zip(columns, values)):
        rank = F.lit(0)
        for bound in bounds[column]:
            rank = rank + F.coalesce((value >= F.lit(bound)).cast("int"), F.lit(0))
        for bit in range(RANK_BITS):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("long")
            z = z + F.shiftleft(one, bit * len(columns) + len(columns) - 1 - i)
    return z


def _as_number(df: DataFrame, column: str) -> Column:
    """A number in the column's order: times as seconds."""
    value, data_type = F.col(column), df.schema[column].dataType
    if isinstance(data_type, (DateType, TimestampNTZType)):
        value = value.cast("timestamp")
    return value.cast("double")


# --- catalog details -------------------------------------------------------------------------------------------


def _name(table: str) -> str:
    return ".".join(f"`{part}`" for part in table.split("."))


def _ddl(schema: StructType) -> str:
    return ", ".join(
        f"{_quoted(f.name)} {_type_ddl(f.dataType)}" for f in schema.fields)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _type_ddl(kind: DataType) -> str:
    """A type as SQL text, with the names of nested fields quoted."""
    if isinstance(kind, NullType):
        return "string"
    if isinstance(kind, StructType):
        return f"struct<{', '.join(f'{_quoted(f.name)}: {_type_ddl(f.dataType)}' for f in kind.fields)}>"
    if isinstance(kind, ArrayType):
        return f"array<{_type_ddl(kind.elementType)}>"
    if isinstance(kind, MapType):
        return f"map<{_type_ddl(kind.keyType)}, {_type_ddl(kind.valueType)}>"
    return kind.simpleString()


def _columns(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def _create(spark: SparkSession, table: str, schema: StructType, location: str | None = None,
            parted: bool = False, properties: str = "") -> None:
    spark.sql(" ".join([
        f"CREATE TABLE {_name(table)} ({_ddl(schema)}) USING parquet",
        f"PARTITIONED BY ({PART})" if parted else "",
        f"LOCATION '{location}'" if location else "",
        properties,
    ]))


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_name(table)}").collect()
    return {row.col_name: row.data_type for row in rows}


def _location(spark: SparkSession, table: str) -> str:
    return _described(spark, table)["Location"]


def _is_external(spark: SparkSession, table: str) -> bool:
    return _described(spark, table)["Type"] == "EXTERNAL"


def _default_location(spark: SparkSession, table: str) -> str:
    schema, _, short = table.rpartition(".")
    database = spark.catalog.getDatabase(schema or spark.catalog.currentDatabase())
    return f"{database.locationUri.rstrip('/')}/{short}"


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {_name(table)}").collect()}


def bucket_count(spark: SparkSession, table: str) -> int:
    return bucket_counts(spark, table)[0]


def bucket_counts(spark: SparkSession, table: str) -> tuple[int, int]:
    """How many buckets a merge table has, and had when it was made."""
    found = _properties(spark, table)
    return int(found[BUCKETS_PROPERTY]), int(found.get(BASE_PROPERTY, found[BUCKETS_PROPERTY]))


def ensure_merge_table(spark: SparkSession, df: DataFrame, table: str, buckets: int = DEFAULT_BUCKETS) -> None:
    ensure_schema(spark, table)
    if not exists(spark, table):
        last = StructType([f for f in df.schema.fields if f.name != PART] + [df.schema[PART]])
        _create(spark, table, last, parted=True, properties=f"TBLPROPERTIES ('{BUCKETS_PROPERTY}' = '{buckets}')")


def aligned(spark: SparkSession, df: DataFrame, table: str) -> DataFrame:
    """Widen the table by the frame's new columns, then order the frame by the table's columns."""
    schema = evolve(spark, df.schema, table)
    have = {c.lower(): c for c in df.columns}
    given = {f.name.lower(): f.dataType for f in df.schema.fields}
    lossy = [f"{f.name}: {given[f.name.lower()].simpleString()} to {f.dataType.simpleString()}" for f in schema.fields
             if f.name.lower() in given and _loses(given[f.name.lower()], f.dataType)]
    if lossy:
        raise ValueError(f"table {table!r} cannot hold these values without loss: {', '.join(lossy)}")
    return df.select(*[
        (F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])


# Bits of value that a numeric type holds exactly.
_WHOLE = {"tinyint": 7, "smallint": 15, "int": 31, "bigint": 63}
_REAL = {"float": 24, "double": 53}


def _loses(given: DataType, wanted: DataType) -> bool:
    """Whether a cast could change numbers or times (texts and nested values are left to the cast)."""
    a, b = given.simpleString(), wanted.simpleString()
    if a == b:
        return False
    if a in _WHOLE:
        return b in _WHOLE and _WHOLE[b] < _WHOLE[a] or b == "boolean"
    if a in _REAL:
        return b in _WHOLE or _REAL.get(b, 53) < _REAL[a] or b.startswith("decimal")
    if isinstance(given, DecimalType):
        return b in _WHOLE or isinstance(wanted, DecimalType) and (
            wanted.scale < given.scale or wanted.precision - wanted.scale < given.precision - given.scale)
    return a.startswith("timestamp") and b == "date"


def overwrite_parts(spark: SparkSession, df: DataFrame, table: str) -> set[int]:
    """Replace the table's partitions that ``df`` (with the table's columns) has rows for; others stay untouched.

    Returns the layout values of the replaced ones.
    """
    root = f"{_location(spark, table).rstrip('/')}/_batches"
    folder = f"{root}/{_stamp()}"
    df.write.partitionBy(PART).parquet(folder)
    parts = [part for _, part in _batch_folders(spark, root, folder.rsplit("/", 1)[1])]
    known = {row[0] for row in spark.sql(f"SHOW PARTITIONS {_name(table)}").collect()}
    added = [f"PARTITION ({part}) LOCATION '{folder}/{part}'" for part in parts if part not in known]
    _each(lambda some: spark.sql(f"ALTER TABLE {_name(table)} ADD {some}"),
          [" ".join(added[i:i + PER_CALL]) for i in range(0, len(added), PER_CALL)])
    again = [part for part in parts if part in known]
    _each(lambda part: spark.sql(
        f"ALTER TABLE {_name(table)} PARTITION ({part}) SET LOCATION '{folder}/{part}'"), again)
    spark.catalog.refreshTable(table)
    _retire_parts(spark, root, again)
    return {int(part.split("=")[1]) for part in parts}


def _each(step: Callable[[str], object], items: Sequence[str]) -> None:
    """Do a step for every item, a few at a time: each is a short call that mostly waits."""
    with ThreadPoolExecutor(CALLS) as calls:
        for _ in calls.map(step, items):
            pass


def _stamp() -> str:
    """A fresh folder name; names sort by time."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _retire_parts(spark: SparkSession, root: str, parts: Sequence[str]) -> None:
    """Remove all but the newest ``KEPT_VERSIONS`` of each partition's folders among the batches below ``root``.

    One listing for all partitions: a listing per partition would read every batch folder once for each of them.
    """
    if not parts:
        return
    wanted, found = set(parts), {}
    for stamp, part in _batch_folders(spark, root):
        if part in wanted:
            found.setdefault(part, []).append(stamp)
    files = spark._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    gone = [f"{root}/{old}/{part}" for part, stamps in found.items() for old in sorted(stamps)[:-KEPT_VERSIONS]]
    _each(lambda old: files.delete(spark._jvm.org.apache.hadoop.fs.Path(old), True), gone)


def _batch_folders(spark: SparkSession, root: str, batch: str = "*") -> list[tuple[str, str]]:
    """The stamp and the partition of each folder that a batch, or any batch, below ``root`` wrote."""
    hadoop = spark._jvm.org.apache.hadoop
    path, conf = hadoop.fs.Path(f"{root}/{batch}/{PART}=*"), spark._jsc.hadoopConfiguration()
    found = path.getFileSystem(conf).globStatus(path)
    if not found:
        return []
    # One text of all paths: to ask path by path would be some calls of the JVM for each.
    job = hadoop.mapred.JobConf(conf)
    hadoop.mapred.FileInputFormat.setInputPaths(job, hadoop.fs.FileUtil.stat2Paths(found))
    return re.findall(rf"/(\d+-[0-9a-f]+)/({PART}=-?\d+)(?=,|$)", job.get("mapreduce.input.fileinputformat.inputdir"))


def _retire(spark: SparkSession, pattern: str) -> None:
    """Remove all but the newest ``KEPT_VERSIONS`` of the folders that match."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = sorted(status.getPath().toString() for status in files.globStatus(path) or [])
    for old in found[:-KEPT_VERSIONS]:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(old), True)
