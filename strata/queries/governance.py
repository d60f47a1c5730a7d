"""Masks and the row filter, in both forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions import governance
from strata.queries.inputs import TRANSACTIONS, as_double, scratch_schema, table, transactions
from strata.queries.quality import CONTACTS, _contacts

READER = ("region_asia", "region_europe")


def _customers(spark, folder):
    return table(spark, folder, "customer").select("c_custkey", "c_name", F.col("c_custkey").cast("string").alias("id"))


def _redact(spark, folder):
    return _customers(spark, folder).select(
        "c_custkey", governance.redact(F.col("c_name"), READER).alias("for_reader"),
        governance.redact(F.col("c_name"), [governance.STEWARDS]).alias("for_steward"))


def _partial_id(spark, folder):
    return _customers(spark, folder).select(
        "c_custkey", governance.partial_id(F.col("c_name"), READER).alias("name"),
        governance.partial_id(F.col("id"), READER).alias("short"))


def _email(spark, folder):
    return _contacts(spark, folder).select(
        "c_custkey", governance.mask_email(F.col("customer_email"), READER).alias("email"))


EMAIL_SQL = f"""
    SELECT c_custkey, CASE WHEN customer_email IS NULL THEN NULL
                           WHEN customer_email LIKE '%@%' THEN 'masked-user@example.com'
                           ELSE '### REDACTED ###' END AS email
    FROM ({CONTACTS})"""


def _row_filter(spark, folder):
    return governance.row_filter(as_double(transactions(spark, folder), "amount"), "region", READER)


def _row_filter_table(spark, folder):
    # Entitlements: user `analyst` holds the regions whose name begins with A.
    regions = table(spark, folder, "region").filter(F.col("r_name").startswith("A"))
    entitled = regions.select(F.lit("analyst").alias("user"), F.lower("r_name").alias("region"))
    rows = as_double(transactions(spark, folder), "amount")
    return governance.row_filter_by_table(rows, "region", entitled, "analyst")


def _governed_view(spark, folder):
    schema = scratch_schema(spark, "governed")
    as_double(transactions(spark, folder), "amount").write.saveAsTable(f"{schema}.tx")
    groups = spark.range(1).select(F.current_user().alias("user"), F.explode(F.array(*map(F.lit, READER))).alias("group"))
    groups.write.saveAsTable(f"{schema}.members")
    governance.publish_view(spark, f"{schema}.tx", f"{schema}.shown", f"{schema}.members", {"customer_id": "partial_id"},
                            "region")
    return spark.table(f"{schema}.shown")


def _sql_functions(spark, folder):
    governance.register_sql(spark, READER)
    contacts = _contacts(spark, folder).join(
        table(spark, folder, "customer").join(
            table(spark, folder, "nation").join(
                table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")),
            F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "r_name"), "c_custkey")
    return contacts.filter(F.expr("regional_filter(r_name)")).select(
        "c_custkey", F.expr("redact_mask(customer_email)").alias("redacted"),
        F.expr("partial_id_mask(phone_number)").alias("phone"), F.expr("email_mask(customer_email)").alias("email"))


SQL_FUNCTIONS_SQL = f"""
    SELECT c_custkey, '### REDACTED ###' AS redacted, 'XXXX-' || right(phone_number, 4) AS phone,
           CASE WHEN customer_email LIKE '%@%' THEN 'masked-user@example.com'
                WHEN customer_email IS NOT NULL THEN '### REDACTED ###' END AS email
    FROM ({CONTACTS}) JOIN customer USING (c_custkey) JOIN nation ON c_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey
    WHERE r_name IN ('ASIA', 'EUROPE')"""

QUERIES = {
    "mask_redact": (_redact, """
        SELECT c_custkey, '### REDACTED ###' AS for_reader, c_name AS for_steward FROM customer"""),
    "mask_partial_id": (_partial_id, """
        SELECT c_custkey, 'XXXX-' || right(c_name, 4) AS name,
               'XXXX-' || right(CAST(c_custkey AS VARCHAR), 4) AS short FROM customer"""),
    "mask_email": (_email, EMAIL_SQL),
    "row_filter": (_row_filter, f"""
        SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM ({TRANSACTIONS})
        WHERE region IN ('ASIA', 'EUROPE')"""),
    "row_filter_table": (_row_filter_table, f"""
        SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM ({TRANSACTIONS}) WHERE region LIKE 'A%'"""),
    "governed_view": (_governed_view, f"""
        SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount,
                          'XXXX-' || right(CAST(customer_id AS VARCHAR), 4) AS customer_id)
        FROM ({TRANSACTIONS}) WHERE region IN ('ASIA', 'EUROPE')"""),
    "governance_sql": (_sql_functions, SQL_FUNCTIONS_SQL),
}
