"""Whole runs from a manifest, and the layer report."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.plans import audit, manifest
from strata.queries.inputs import (
    AVERAGE, CUSTOMERS, FAULTY, TRANSACTIONS, TX_SCHEMA, as_double, customers, faulty, scratch_schema, table,
    transactions)
from strata.session import shared_dir
from strata.sources import files, tables


def sales_manifest(schema: str) -> dict:
    """Nested JSON, CSV and Parquet files to three silver tables and one KPI table."""
    return {"settings": {"run_mode": "local"}, "tables": [
        {"name": "raw_ingestion", "type": "bronze", "source_path": "/landing/", "target_table": f"{schema}.raw",
         "max_bytes": 1_000_000},
        {"name": "tx_nested", "type": "silver", "format": "json", "source_table": f"{schema}.raw",
         "target_table": f"{schema}.tx_json", "explode_col": "items",
         "schema": "store_id STRING, tx_date STRING, items ARRAY<STRUCT<tx_id: STRING, amount: DECIMAL(18, 2), "
                   "region: STRING, tx_time: STRING>>",
         "rules": ["amount > 0", "tx_id IS NOT NULL", "region IS NOT NULL"]},
        {"name": "tx_legacy", "type": "silver", "format": "csv", "source_table": f"{schema}.raw",
         "target_table": f"{schema}.tx_csv", "schema": TX_SCHEMA,
         "rules": ["amount IS NOT NULL", "amount > 0"]},
        {"name": "tx_typed", "type": "silver", "format": "parquet", "source_table": f"{schema}.raw",
         "target_table": f"{schema}.tx_parquet", "schema": TX_SCHEMA, "rules": ["amount IS NOT NULL"]},
        {"name": "kpis", "type": "gold", "source_table": f"{schema}.tx_json", "target_table": f"{schema}.kpis",
         "group_by": ["region"], "sort_by": "total_revenue", "cluster_by": ["region"],
         "aggregations": {"total_revenue": "sum(amount)", "transaction_count": "count(tx_id)",
                          "avg_ticket_size": "avg(amount)", "last_transaction_at": "max(tx_time)"}},
    ]}


def _run_sales(spark, folder):
    base, schema = shared_dir(spark, "sales"), scratch_schema(spark, "sales")
    rows = faulty(spark, folder)
    # One nested document per order: its transaction, and a negative copy of it.
    item = [F.col(c) for c in ("tx_id", "amount", "region", "tx_time")]
    bad = [F.col("tx_id"), F.lit("-1.00").alias("amount"), F.col("region"), F.col("tx_time")]
    nested = rows.select(
        F.col("o_orderkey").cast("string").alias("store_id"), F.substring("tx_time", 1, 10).alias("tx_date"),
        F.array(F.struct(*item), F.struct(*bad)).alias("items"))
    nested.write.option("ignoreNullFields", "false").json(f"{base}/landing/nested")
    flat = rows.select("tx_id", "amount", "region", "tx_time")
    files.export(flat, f"{base}/landing/legacy", "csv")
    files.export(flat.withColumn("amount", F.col("amount").try_cast("double")), f"{base}/landing/typed", "parquet")
    spec = sales_manifest(schema)
    manifest.run(spark, spec, base, user="tester")
    return spec, schema


def _manifest_run(spark, folder):
    _, schema = _run_sales(spark, folder)
    return as_double(tables.read(spark, f"{schema}.kpis"), "total_revenue", "avg_ticket_size")


_TYPED = f"SELECT tx_id, try_cast(amount AS DECIMAL(18, 2)) AS amount, region, tx_time FROM ({FAULTY})"
_NESTED_GOOD = "amount > 0 AND tx_id IS NOT NULL AND region IS NOT NULL"
MANIFEST_SQL = f"""
    SELECT region, CAST(sum(amount) AS DOUBLE) AS total_revenue, count(tx_id) AS transaction_count,
           {AVERAGE} AS avg_ticket_size, max(tx_time) AS last_transaction_at
    FROM ({_TYPED}) WHERE {_NESTED_GOOD} GROUP BY region"""


def _layer_report(spark, folder):
    spec, schema = _run_sales(spark, folder)
    report = manifest.report(spark, spec).filter("layer <> 'bronze'")
    return report.select("layer", F.replace("table", F.lit(f"{schema}."), F.lit("")).alias("table"), "rows", "valid",
                         "quarantined", (F.col("files") > 0).alias("has_files"))


REPORT_SQL = " UNION ALL ".join(
    f"""SELECT 'silver' AS layer, '{name}' AS "table", {times} * count(*) AS rows,
               count(*) FILTER ({good}) AS valid, {times} * count(*) - count(*) FILTER ({good}) AS quarantined,
               true AS has_files
        FROM ({_TYPED})"""
    for name, times, good in (("tx_json", 2, _NESTED_GOOD), ("tx_csv", 1, "amount > 0"),
                              ("tx_parquet", 1, "amount IS NOT NULL"))
) + f" UNION ALL SELECT 'gold', 'kpis', count(*), NULL, NULL, NULL FROM ({MANIFEST_SQL})"


def churn_manifest(schema: str) -> dict:
    """Customers and transactions as Parquet to a feature table."""
    return {"settings": {"run_mode": "local"}, "tables": [
        {"name": "ml_ingestion", "type": "bronze", "source_path": "/landing/ml_data",
         "target_table": f"{schema}.ml_raw"},
        {"name": "ml_customers", "type": "silver", "format": "parquet", "source_table": f"{schema}.ml_raw",
         "target_table": f"{schema}.customers", "merge_key": "customer_id", "buckets": 8,
         "schema": "customer_id STRING, tenure_months INT, support_tickets INT, tier STRING, is_churned INT",
         "rules": ["support_tickets < 9", "customer_id IS NOT NULL"]},
        {"name": "ml_transactions", "type": "silver", "format": "parquet", "source_table": f"{schema}.ml_raw",
         "target_table": f"{schema}.transactions", "merge_key": "tx_id", "buckets": 8,
         "schema": "tx_id STRING, customer_id STRING, amount DECIMAL(18, 2), tx_time STRING",
         "rules": ["customer_id IS NOT NULL", "amount > 0"]},
        {"name": "features", "type": "gold", "source_table": f"{schema}.customers",
         "target_table": f"{schema}.churn_features",
         "joins": [{"table": f"{schema}.transactions", "on": "customer_id", "type": "left"}],
         "group_by": ["customer_id", "tenure_months", "support_tickets", "tier", "is_churned"],
         "aggregations": {"total_lifetime_spend": "sum(amount)", "avg_tx_value": "avg(amount)",
                          "frequency_score": "count(tx_id)"}},
    ]}


def _manifest_churn(spark, folder):
    base, schema = shared_dir(spark, "churn"), scratch_schema(spark, "churn")
    text_id = F.col("customer_id").cast("string")
    people = customers(spark, folder).withColumn("customer_id", text_id)
    files.export(people, f"{base}/landing/ml_data/customers", "parquet")
    bought = transactions(spark, folder).select(
        "tx_id", text_id.alias("customer_id"), "amount", F.col("tx_time").cast("string").alias("tx_time"))
    files.export(bought, f"{base}/landing/ml_data/transactions", "parquet")
    # Both silver tables read one folder: rows of the other entity fail the rules. NULL keys never match anything.
    manifest.run(spark, churn_manifest(schema), base)
    return as_double(tables.read(spark, f"{schema}.churn_features"), "total_lifetime_spend", "avg_tx_value")


MANIFEST_CHURN_SQL = f"""
    SELECT CAST(c.customer_id AS VARCHAR) AS customer_id, tenure_months, support_tickets, tier, is_churned,
           CAST(sum(amount) AS DOUBLE) AS total_lifetime_spend, {AVERAGE} AS avg_tx_value,
           count(tx_id) AS frequency_score
    FROM ({CUSTOMERS}) c LEFT JOIN ({TRANSACTIONS}) t ON c.customer_id = t.customer_id
    WHERE support_tickets < 9
    GROUP BY ALL"""


def _source_guard(spark, folder):
    # An optional entry whose source is absent is skipped and the others run; one that is not optional stops the run.
    base, schema = shared_dir(spark, "guard"), scratch_schema(spark, "guard")
    table(spark, folder, "orders").write.saveAsTable(f"{schema}.orders")
    present = {"name": "by_status", "type": "gold", "source_table": f"{schema}.orders",
               "target_table": f"{schema}.by_status", "group_by": ["o_orderstatus"],
               "aggregations": {"n": "count(o_orderkey)"}}
    absent = {**present, "name": "absent", "source_table": f"{schema}.absent", "target_table": f"{schema}.none"}
    settings = {"settings": {"run_mode": "local"}}
    manifest.run(spark, {**settings, "tables": [{**absent, "optional": True}, present]}, base)
    try:
        manifest.run(spark, {**settings, "tables": [absent]}, base)
        refused = False
    except ValueError:
        refused = True
    return tables.read(spark, f"{schema}.by_status").withColumns({
        "refused": F.lit(refused), "skipped": F.lit(not tables.exists(spark, f"{schema}.none"))})


def _path_report(spark, folder):
    # Folders of Parquet in place of tables: orders by status, and customers without the names of their files.
    base = shared_dir(spark, "paths")
    table(spark, folder, "orders").withColumn("source_file", F.concat(F.lit("orders-"), "o_orderstatus")).write.parquet(
        f"{base}/orders")
    table(spark, folder, "customer").write.parquet(f"{base}/customers")
    report = audit.layer_report(spark, [("bronze", f"{base}/orders"), ("gold", f"{base}/customers")])
    return report.select("layer", F.element_at(F.split("table", "/"), -1).alias("table"), "rows", "files", "valid",
                         "quarantined")


PATH_REPORT_SQL = """
    SELECT 'bronze' AS layer, 'orders' AS "table", count(*) AS rows, count(DISTINCT o_orderstatus) AS files,
           NULL AS valid, NULL AS quarantined FROM orders
    UNION ALL SELECT 'gold', 'customers', count(*), NULL, NULL, NULL FROM customer"""

QUERIES = {
    "source_guard": (_source_guard, """
        SELECT o_orderstatus, count(*) AS n, true AS refused, true AS skipped FROM orders GROUP BY o_orderstatus"""),
    "path_report": (_path_report, PATH_REPORT_SQL),
    "manifest_run": (_manifest_run, MANIFEST_SQL),
    "manifest_churn": (_manifest_churn, MANIFEST_CHURN_SQL),
    "layer_report": (_layer_report, REPORT_SQL),
}
