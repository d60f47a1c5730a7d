"""Streaming jobs. Each call lands the test tables as files in a new folder and runs the streams to the end."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import payload
from strata.queries.inputs import FAULTY, TX_SCHEMA, faulty, scratch_schema, table
from strata.session import shared_dir
from strata.sources import files, tables
from strata.streaming import bronze, silver

TIMEOUT = 1800


def _bronze(spark, folder):
    # Two drops with a run after each: the second run must see the new files only. A small size limit sends some
    # files down the line-by-line way.
    landing, checkpoint = shared_dir(spark, "landing"), shared_dir(spark, "checkpoint")
    raw = f"{scratch_schema(spark, 'bronze')}.raw"
    events = table(spark, folder, "events").select("event_id", "event_type")
    for drop in ("first", "second"):
        files.export(events, f"{landing}/{drop}/events", "json")
        files.export(table(spark, folder, "orders").select("o_orderkey", "o_orderstatus"),
                     f"{landing}/{drop}/orders", "csv")
        files.export(table(spark, folder, "customer"), f"{landing}/{drop}/customers", "parquet")
        bronze.ingest_raw(spark, landing, raw, checkpoint, "raw_ingestion", max_bytes=100_000, timeout=TIMEOUT)
    lines = payload.payload_lines(spark.table(raw))
    return lines.filter(~((F.col("file_format") == "csv") & F.col("line").startswith("o_orderkey"))).groupBy(
        "file_format", "_pipeline_run_id").agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.col("source_file").contains("/second/")).alias("in_second"),
        F.count_if(F.col("ingested_at").isNull()).alias("without_time"))


BRONZE_SQL = """
    SELECT 'json' AS file_format, 'raw_ingestion' AS _pipeline_run_id, 2 * count(*) AS records,
           count(*) AS in_second, CAST(0 AS BIGINT) AS without_time FROM events
    UNION ALL SELECT 'csv', 'raw_ingestion', 2 * count(*), count(*), 0 FROM orders"""


def _structured(spark, folder):
    # The folder also holds files of another format, and the declared schema asks for a column the files lack.
    landing = shared_dir(spark, "landing")
    files.export(table(spark, folder, "events").drop("props"), f"{landing}/events", "parquet")
    files.export(table(spark, folder, "nation"), f"{landing}/other", "csv")
    target = f"{scratch_schema(spark, 'typed')}.events"
    schema = "event_id LONG, ts TIMESTAMP_NTZ, user_id LONG, event_type STRING, value DOUBLE, added STRING"
    bronze.ingest_typed(spark, landing, schema, target, shared_dir(spark, "checkpoint"), "typed", timeout=TIMEOUT)
    return spark.table(target).select(
        "event_id", "ts", "user_id", "event_type", "value", "added",
        F.col("source_file").endswith(".parquet").alias("has_lineage"))


STRUCTURED_SQL = """
    SELECT event_id, ts, user_id, event_type, value, CAST(NULL AS VARCHAR) AS added, true AS has_lineage
    FROM events"""

RULES = {"has_id": "tx_id IS NOT NULL", "positive": "amount > 0", "has_region": "region IS NOT NULL"}
_GOOD = "tx_id IS NOT NULL AND coalesce(amount > 0, false) AND region IS NOT NULL"


def _silver(spark, folder):
    """Drop 1: all transactions. Drop 2: finished ones again with another amount, and new ones. Then a replay of
    the streams from a fresh checkpoint over the same tables."""
    landing, schema = shared_dir(spark, "landing"), scratch_schema(spark, "silver")
    raw, spec = f"{schema}.raw", silver.SilverTable(
        "transactions", f"{schema}.tx", TX_SCHEMA, "csv", rules=RULES, merge_key="tx_id", order_by=["tx_time"],
        buckets=8)
    tx = faulty(spark, folder)
    done = tx.filter("o_orderstatus = 'F'")
    second = done.withColumn("amount", F.lit("1.5")).withColumn("tx_time", F.lit("2030-01-01 00:00:00")).unionByName(
        done.withColumn("tx_id", F.concat(F.lit("NEW-"), F.col("o_orderkey"))))

    def run(checkpoints):
        bronze.ingest_raw(spark, landing, raw, f"{checkpoints}/raw", "raw", max_bytes=100_000, timeout=TIMEOUT)
        silver.from_bronze(spark, raw, spec, f"{checkpoints}/silver", timeout=TIMEOUT)

    for name, drop in (("first", tx), ("second", second)):
        files.export(drop.select("tx_id", "amount", "region", "tx_time"), f"{landing}/{name}", "csv")
        run(f"{landing}.checkpoints")
    run(f"{landing}.checkpoints-of-replay")
    good = tables.read(spark, spec.target).select("tx_id", "amount", "region", "tx_time")
    bad = tables.read(spark, spec.quarantine).select(
        "tx_id", "amount", "region", "tx_time", F.array_join("failure_reasons", "|").alias("failure_reasons"))
    return good.unionByName(bad, allowMissingColumns=True)


_REASONS = """concat_ws('|', CASE WHEN tx_id IS NULL THEN 'has_id' END,
    CASE WHEN NOT coalesce(amount > 0, false) THEN 'positive' END, CASE WHEN region IS NULL THEN 'has_region' END)"""
SILVER_SQL = f"""
    WITH first AS (
        SELECT o_orderkey, o_orderstatus, tx_id, try_cast(amount AS DOUBLE) AS amount, region, tx_time
        FROM ({FAULTY})),
    second AS (
        SELECT o_orderkey, tx_id, 1.5 AS amount, region, '2030-01-01 00:00:00' AS tx_time FROM first
        WHERE o_orderstatus = 'F'
        UNION ALL
        SELECT o_orderkey, 'NEW-' || o_orderkey, amount, region, tx_time FROM first WHERE o_orderstatus = 'F'),
    good AS (
        SELECT tx_id, amount, region, tx_time FROM second WHERE {_GOOD}
        UNION ALL
        SELECT tx_id, amount, region, tx_time FROM first
        WHERE {_GOOD} AND tx_id NOT IN (SELECT tx_id FROM second WHERE {_GOOD})),
    bad AS (
        SELECT tx_id, amount, region, tx_time FROM first WHERE NOT ({_GOOD})
        UNION ALL SELECT tx_id, amount, region, tx_time FROM second WHERE NOT ({_GOOD}))
    SELECT tx_id, amount, region, tx_time, CAST(NULL AS VARCHAR) AS failure_reasons FROM good
    UNION ALL SELECT tx_id, amount, region, tx_time, {_REASONS} FROM bad"""

QUERIES = {
    "stream_bronze": (_bronze, BRONZE_SQL),
    "stream_structured": (_structured, STRUCTURED_SQL),
    "stream_silver_upsert": (_silver, SILVER_SQL),
}
