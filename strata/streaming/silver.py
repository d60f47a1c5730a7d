"""Bronze to silver: parse, check, quarantine and upsert, batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from strata.functions.audit import with_audit
from strata.operators import payload, quality
from strata.sources import history_tables, tables
from strata.sources.files import structured_files, with_lineage
from strata.streaming.bronze import run_to_end


# The most text of file headers that is broadcast.
BROADCAST_CHARS = 100_000_000


@dataclass
class SilverTable:
    """What one silver table is made of."""

    name: str
    target: str
    schema: str
    file_format: str = "json"
    explode: str | None = None
    rules: quality.Rules = field(default_factory=dict)
    merge_key: str | None = None
    order_by: Sequence[str] = ()
    buckets: int = tables.DEFAULT_BUCKETS
    run_mode: str = "local"
    user: str | None = None
    # Bytes of bronze (or typed) files per batch; all that is new by default.
    batch_bytes: int | None = None
    # A folder for the parsed batch. Without it the batch is cached on the executors, which suits batches that fit
    # there; a backfill is better written once and read back column by column.
    stage: str | None = None
    # Keep JSON records with undeclared or ill-typed fields in the rescued column, beside their fields.
    rescue_fields: bool = False
    # The column whose greatest valid value the metrics report as the latest event.
    event_time: str = "ingested_at"
    # Columns that the table's files hold ranges of.
    cluster_by: Sequence[str] = ()
    # Keep a type-2 history of the valid rows instead: ``keys``, ``tracked`` and ``order_by`` columns.
    history: Mapping[str, Sequence[str]] | None = None
    # A table for the counts per rule of each batch.
    metrics: str | None = None

    @property
    def quarantine(self) -> str:
        return f"{self.target}_quarantine"


def parsed(raw: DataFrame, spec: SilverTable, headers: DataFrame | None = None,
           lines: DataFrame | None = None) -> DataFrame:
    """Raw rows of the table's format, as typed and exploded rows."""
    rows = payload.of_format(raw, spec.file_format)
    if spec.file_format == "json":
        rows = payload.parse_json(rows, spec.schema, rescue_fields=spec.rescue_fields, lines=lines)
    elif spec.file_format == "csv":
        rows = payload.parse_csv(rows, spec.schema, headers=headers)
    else:
        raise ValueError(f"no payload parser for format {spec.file_format!r}")
    return exploded(rows, spec)


def exploded(rows: DataFrame, spec: SilverTable) -> DataFrame:
    return payload.explode_items(rows, spec.explode) if spec.explode and spec.explode in rows.columns else rows


def store_batch(rows: DataFrame, batch_id: int, spec: SilverTable) -> dict[str, int]:
    """Check one batch and write its valid and its quarantined rows. Replaying a batch changes nothing."""
    spark = rows.sparkSession
    tagged = with_audit(quality.apply_rules(rows, spec.rules), spec.name, spec.run_mode, spec.user)
    # Both writes (and the merge, which reads its source more than once) share one parse.
    if spec.stage:
        tagged.write.mode("overwrite").parquet(spec.stage)
        tagged = spark.read.schema(tagged.schema).parquet(spec.stage)
    else:
        # Blocks lost with an executor are parsed again from the bronze files.
        tagged = tagged.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        valid, _ = quality.split(tagged)
        # Few rows out of many tasks: gathered into few files.
        tables.append_batch(spark, quality.quarantine(tagged), spec.quarantine, batch_id, spec.name, rebalance=True)
        if spec.history:
            history_tables.merge(spark, valid, spec.target, buckets=spec.buckets, **spec.history)
        elif spec.merge_key:
            # The stream cuts the batches, so no row may win by the batch it came in.
            tables.upsert(spark, valid, spec.target, spec.merge_key, batch_id, spec.order_by, spec.buckets,
                          spec.name, spec.cluster_by, ties="greatest")
        else:
            tables.append_batch(spark, valid, spec.target, batch_id, spec.name, cluster_by=spec.cluster_by)
        if spec.metrics:
            per_rule = quality.metrics(tagged, spec.rules, spec.event_time)
            tables.append_batch(spark, per_rule.select(
                F.lit(spec.target).alias("table"), F.lit(batch_id).cast("long").alias("batch_id"), "*"),
                spec.metrics, batch_id, spec.name)
        # Reads one column of the shared parse.
        return tagged.agg(*quality.batch_metrics()).first().asDict()
    finally:
        if not spec.stage:
            tagged.unpersist()


def _run(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str, timeout: int | None) -> None:
    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    run_to_end(writer.trigger(availableNow=True).start(), timeout)


def from_bronze(spark: SparkSession, source_table: str, spec: SilverTable, checkpoint: str,
                timeout: int | None = None) -> list[dict[str, int]]:
    """Read what is new in a raw bronze table into silver; returns the row counts of each batch.

    With a new checkpoint all of bronze is read again. The batches may be cut otherwise than before, so the partitions of
    earlier batches that no batch of the replay has written are dropped at its end, and the tables hold each row once.
    """
    written = [spec.quarantine, *([] if spec.history else [spec.target]), *([spec.metrics] if spec.metrics else [])]
    if _is_new(spark, checkpoint):
        for table in written:
            tables.begin_replay(spark, table, spec.name)
    done: list[dict[str, int]] = []

    def batch(raw: DataFrame, batch_id: int) -> None:
        headers = _headers(raw, source_table) if spec.file_format == "csv" else None
        lines = _lines(raw, source_table) if spec.file_format == "json" and spec.batch_bytes else None
        done.append(store_batch(parsed(raw, spec, headers, lines), batch_id, spec))

    reader = spark.readStream
    if spec.batch_bytes:
        reader = reader.option("maxBytesPerTrigger", str(spec.batch_bytes))
    # Filtered on the stream: a batch function gets rows that are already read, too late to skip files by format.
    _run(payload.of_format(reader.table(source_table), spec.file_format), batch, checkpoint, timeout)
    for table in written:
        tables.end_replay(spark, table, spec.name)
    return done


def _is_new(spark: SparkSession, checkpoint: str) -> bool:
    """Whether no stream has begun a batch with this checkpoint."""
    offsets = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/offsets/*")
    return not offsets.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(offsets)


def _lines(raw: DataFrame, source_table: str) -> DataFrame | None:
    """All lines of the oversize JSON files that the batch has lines of, from the bronze files of the same ingestion."""
    pieces = payload.of_format(raw, "json").filter(F.col("chunk_line").isNotNull())
    since, until = pieces.agg(F.min("ingested_at"), F.max("ingested_at")).first()
    if since is None:
        return None
    bronze = payload.of_format(raw.sparkSession.read.table(source_table), "json")
    return bronze.filter(F.col("ingested_at").between(since, until) & F.col("chunk_line").isNotNull()).join(
        pieces.select("source_file").distinct(), "source_file", "left_semi")


def _headers(raw: DataFrame, source_table: str) -> DataFrame:
    """Header lines for the batch's rows of oversize CSV files.

    A file's lines may be spread over two silver batches, so its first line is looked up in the bronze table. All of
    a file was ingested at one instant: that range prunes the lookup to the bronze files of the same ingestion.
    """
    pieces = payload.of_format(raw, "csv").filter(F.col("chunk_line").isNotNull())
    since, until = pieces.agg(F.min("ingested_at"), F.max("ingested_at")).first()
    if since is None:
        return payload.csv_headers(raw)
    bronze = payload.of_format(raw.sparkSession.read.table(source_table), "csv")
    headers = payload.csv_headers(bronze.filter(F.col("ingested_at").between(since, until)))
    # One short row per oversize file. While they fit, a broadcast spares the lines a shuffle; beyond, Spark chooses.
    size = headers.agg(F.sum(F.length("source_file") + F.length("_header"))).first()[0] or 0
    return F.broadcast(headers) if size <= BROADCAST_CHARS else headers


def from_typed_files(spark: SparkSession, source: str, spec: SilverTable, checkpoint: str, glob: str | None = None,
                     timeout: int | None = None) -> list[dict[str, int]]:
    """Read new typed files (Parquet) straight into silver, with lineage."""
    done: list[dict[str, int]] = []

    def batch(rows: DataFrame, batch_id: int) -> None:
        done.append(store_batch(exploded(with_lineage(rows), spec), batch_id, spec))

    stream = structured_files(spark, source, spec.schema, True, spec.file_format, glob, spec.batch_bytes)
    _run(stream, batch, checkpoint, timeout)
    return done
