"""The standard gold tables over silver transactions and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.operators import gold

# The published columns of the KPI and feature tables.
REGIONAL_KPIS = {
    "total_revenue": "sum(amount)",
    "transaction_count": "count(tx_id)",
    "avg_ticket_size": "avg(amount)",
    "last_transaction_at": "max(tx_time)",
}
CHURN_FEATURES = {
    "total_lifetime_spend": "sum(amount)",
    "avg_tx_value": "avg(amount)",
    "frequency_score": "count(tx_id)",
}
CHURN_ATTRIBUTES = ("customer_id", "tenure_months", "support_tickets", "tier", "is_churned")


def regional_kpis(transactions: DataFrame) -> DataFrame:
    """Revenue, count, average and latest time per region (few groups; tasks aggregate before the shuffle)."""
    return gold.aggregate(transactions, ["region"], REGIONAL_KPIS)


def churn_features(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Spend features per customer; one without transactions has NULL sums and count 0."""
    return gold.join_aggregate(
        customers, transactions, "customer_id", "left", CHURN_ATTRIBUTES, CHURN_FEATURES)


def monthly_revenue(transactions: DataFrame) -> DataFrame:
    """Revenue per region and month, the previous month's, and the growth in percent.

    "Previous" is the previous month with transactions. Growth is NULL in the first month and after a zero month.
    The window runs over the aggregate: one row per region and month.
    """
    month = F.date_trunc("month", "tx_time").cast(transactions.schema["tx_time"].dataType)
    stats = transactions.groupBy("region", month.alias("report_month")).agg(
        F.sum("amount").alias("total_revenue"), F.count("tx_id").alias("transaction_count"))
    by_month = Window.partitionBy("region").orderBy("report_month")
    rows = stats.withColumn("prev_month_revenue", F.lag("total_revenue").over(by_month))
    change = (F.col("total_revenue") - F.col("prev_month_revenue")).cast("double")
    return rows.withColumn("mom_growth_pct", F.try_divide(change, F.col("prev_month_revenue").cast("double")) * 100)


def create_monthly_revenue_view(transactions: DataFrame, name: str = "v_monthly_revenue") -> DataFrame:
    """Publish the report as a view of the session; it is computed from current data at each use."""
    monthly_revenue(transactions).createOrReplaceTempView(name)
    return transactions.sparkSession.table(name)


def publish_monthly_revenue(spark: SparkSession, source: str, view: str) -> None:
    """The report over a catalog table as a catalog view: it outlives the session, and any SQL client can read it."""
    kind = spark.table(source).schema["tx_time"].dataType.simpleString()
    named = [".".join(f"`{part}`" for part in table.split(".")) for table in (view, source)]
    spark.sql(f"""
        CREATE OR REPLACE VIEW {named[0]} AS
        WITH months AS (
            SELECT region, CAST(date_trunc('month', tx_time) AS {kind}) AS report_month,
                   sum(amount) AS total_revenue, count(tx_id) AS transaction_count
            FROM {named[1]} GROUP BY ALL),
        paired AS (
            SELECT *, lag(total_revenue) OVER (PARTITION BY region ORDER BY report_month) AS prev_month_revenue
            FROM months)
        SELECT *, try_divide(CAST(total_revenue - prev_month_revenue AS DOUBLE),
                             CAST(prev_month_revenue AS DOUBLE)) * 100 AS mom_growth_pct
        FROM paired""")
