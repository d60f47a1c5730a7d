"""Canonical inputs derived from the test tables, in Spark and in SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import shared_dir


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch_schema(spark: SparkSession, purpose: str) -> str:
    """A new catalog schema whose tables lie in the shared folder."""
    name = f"{purpose}_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{shared_dir(spark, name)}'")
    return name


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the region of their customer. Spark broadcasts nation and region by their size."""
    orders = table(spark, folder, "orders")
    regions = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    customers = table(spark, folder, "customer").join(regions, F.col("c_nationkey") == F.col("n_nationkey"))
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(F.lit("TXN-"), F.col("o_orderkey")).alias("tx_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").cast("decimal(18, 2)").alias("amount"),
        F.col("r_name").alias("region"),
        F.col("o_orderdate").alias("tx_time"))


TRANSACTIONS = """
    SELECT 'TXN-' || o_orderkey AS tx_id, o_custkey AS customer_id,
           CAST(o_totalprice AS DECIMAL(18, 2)) AS amount, r_name AS region,
           o_orderdate AS tx_time
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey"""


def as_double(df: DataFrame, *columns: str) -> DataFrame:
    """Exact decimals as doubles, for comparison."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


# Spark's average of a DECIMAL(18, 2) has six digits, rounded half up.
AVERAGE = """CAST((CAST(sum(amount) * 100 AS HUGEINT) * 20000 + count(amount)) // (2 * count(amount)) AS DOUBLE)
    / 1000000"""


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with churn attributes; suppliers join them as prospects, who never have transactions."""
    buyers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        (1 + F.col("c_nationkey") * 2).cast("int").alias("tenure_months"),
        (F.floor(F.abs("c_acctbal")) % 10).cast("int").alias("support_tickets"),
        F.col("c_mktsegment").alias("tier"),
        (F.col("c_acctbal") < 0).cast("int").alias("is_churned"))
    prospects = table(spark, folder, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("customer_id"),
        (1 + F.col("s_nationkey") * 2).cast("int").alias("tenure_months"),
        (F.floor(F.abs("s_acctbal")) % 10).cast("int").alias("support_tickets"),
        F.lit("PROSPECT").alias("tier"),
        (F.col("s_acctbal") < 0).cast("int").alias("is_churned"))
    return buyers.unionByName(prospects)


CUSTOMERS = """
    SELECT c_custkey AS customer_id, CAST(1 + c_nationkey * 2 AS INTEGER) AS tenure_months,
           CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) % 10 AS INTEGER) AS support_tickets, c_mktsegment AS tier,
           CAST(c_acctbal < 0 AS INTEGER) AS is_churned
    FROM customer
    UNION ALL
    SELECT -1 - s_suppkey, CAST(1 + s_nationkey * 2 AS INTEGER),
           CAST(CAST(floor(abs(s_acctbal)) AS BIGINT) % 10 AS INTEGER), 'PROSPECT', CAST(s_acctbal < 0 AS INTEGER)
    FROM supplier"""

CHURN = f"""
    SELECT c.customer_id, tenure_months, support_tickets, tier, is_churned, CAST(sum(amount) AS DOUBLE) AS total_lifetime_spend,
           {AVERAGE} AS avg_tx_value, count(tx_id) AS frequency_score
    FROM ({CUSTOMERS}) c LEFT JOIN ({TRANSACTIONS}) t ON c.customer_id = t.customer_id
    GROUP BY ALL"""


# Faults are planted by the values of other columns, so that each kind occurs in every table size.
NO_ID = "o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'"
CORRUPT_AMOUNT = "o_orderpriority = '5-LOW' AND o_orderstatus = 'F'"
NEGATIVE_AMOUNT = "o_orderpriority = '5-LOW' AND o_orderstatus = 'O'"
NO_REGION = "o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P'"

_FAULTY_COLUMNS = (
    f"CASE WHEN NOT ({NO_ID}) THEN concat('TXN-', CAST(o_orderkey AS STRING)) END AS tx_id",
    f"""CASE WHEN {CORRUPT_AMOUNT} THEN 'CORRUPT_STRING' WHEN {NEGATIVE_AMOUNT} THEN '-99.99'
             ELSE CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS STRING) END AS amount""",
    f"CASE WHEN NOT ({NO_REGION}) THEN r_name END AS region",
)


def faulty(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions as text, with planted faults: no id, bad amounts, no region."""
    regions = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    homes = table(spark, folder, "customer").join(regions, F.col("c_nationkey") == F.col("n_nationkey"))
    joined = table(spark, folder, "orders").join(homes, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        "o_orderkey", "o_orderstatus", *map(F.expr, _FAULTY_COLUMNS),
        F.date_format(F.col("o_orderdate"), "yyyy-MM-dd HH:mm:ss").alias("tx_time"))


FAULTY = f"""
    SELECT o_orderkey, o_orderstatus, {", ".join(_FAULTY_COLUMNS)},
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS tx_time
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey"""

TX_SCHEMA = "tx_id STRING, amount DOUBLE, region STRING, tx_time STRING"
