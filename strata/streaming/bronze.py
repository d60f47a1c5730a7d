"""Files to the raw bronze table, incrementally."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from strata.functions.audit import with_audit
from strata.sources import tables
from strata.sources.files import WHOLE_FILE_BYTES, raw_files, structured_files, with_lineage


def run_to_end(query: StreamingQuery, timeout: int | None = None) -> None:
    """Wait until an available-now query has read all its input."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} did not finish within {timeout} s")


def append_stream(spark: SparkSession, stream: DataFrame, target: str, checkpoint: str,
                  timeout: int | None = None, partition_by: Sequence[str] = ()) -> None:
    """Append a stream to a table, exactly once. The table belongs to this stream: its file log is what readers
    trust, so no batch job may append to it. Columns that are new to the table are added to it. A table keeps the
    partitioning it was created with."""
    tables.ensure_schema(spark, target)
    if tables.exists(spark, target):
        tables.evolve(spark, stream.schema, target)
        partition_by = [c.name for c in spark.catalog.listColumns(target) if c.isPartition]
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    run_to_end(writer.toTable(target), timeout)


def ingest_raw(spark: SparkSession, source: str, target: str, checkpoint: str, run_id: str,
               run_mode: str = "local", user: str | None = None, max_bytes: int = WHOLE_FILE_BYTES,
               batch_bytes: int | None = None, timeout: int | None = None) -> None:
    """Append every file below ``source`` that no earlier run has read (``raw_files`` rows, lineage, audit).

    The table is partitioned by file format, so that a reader of one format opens no payload of another.
    """
    rows = with_lineage(raw_files(spark, source, True, max_bytes, batch_bytes))
    append_stream(spark, with_audit(rows, run_id, run_mode, user), target, checkpoint, timeout, ["file_format"])


def ingest_typed(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, run_id: str,
                 run_mode: str = "local", user: str | None = None, file_format: str = "parquet",
                 batch_bytes: int | None = None, timeout: int | None = None) -> None:
    """Append typed files as they are, without a payload detour."""
    rows = with_lineage(structured_files(spark, source, schema, True, file_format, batch_bytes=batch_bytes))
    append_stream(spark, with_audit(rows, run_id, run_mode, user), target, checkpoint, timeout)
