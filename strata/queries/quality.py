"""Quality rules, quarantine, metrics, audit columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.audit import with_audit
from strata.functions.types import conform
from strata.operators import freshness, quality
from strata.queries.inputs import FAULTY, TX_SCHEMA, faulty, scratch_schema, table
from strata.sources import tables

REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE")
RULES = {**quality.transaction_rules(REGIONS, now="'2001-01-01 00:00:00'"), "typed_amount": "amount IS NOT NULL"}

_TYPED = f"""
    SELECT tx_id, try_cast(amount AS DOUBLE) AS amount, region, tx_time FROM ({FAULTY})"""
_CHECKED = f"""
    SELECT *, coalesce(tx_id IS NOT NULL, false) AS r1, coalesce(amount > 0, false) AS r2,
           coalesce(region IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE'), false) AS r3,
           coalesce(tx_time <= '2001-01-01 00:00:00', false) AS r4, amount IS NOT NULL AS r5
    FROM ({_TYPED})"""
_ALL = "r1 AND r2 AND r3 AND r4 AND r5"


def _typed(spark, folder):
    return conform(faulty(spark, folder), TX_SCHEMA)


def _valid(spark, folder):
    return quality.split(quality.apply_rules(_typed(spark, folder), RULES))[0]


def _dropped(spark, folder):
    return quality.expect(quality.valid_rows(_typed(spark, folder), RULES), RULES, "fail")


def _quarantine(spark, folder):
    rows = quality.quarantine(quality.apply_rules(_typed(spark, folder), RULES), "2024-01-01 00:00:00")
    return rows.withColumn("failure_reasons", F.array_join("failure_reasons", "|"))


QUARANTINE_SQL = f"""
    SELECT tx_id, amount, region, tx_time, false AS is_valid, '2024-01-01 00:00:00' AS _quarantine_at,
           concat_ws('|', CASE WHEN NOT r1 THEN 'valid_id' END, CASE WHEN NOT r2 THEN 'positive_amount' END,
                     CASE WHEN NOT r3 THEN 'known_region' END, CASE WHEN NOT r4 THEN 'future_date_check' END,
                     CASE WHEN NOT r5 THEN 'typed_amount' END) AS failure_reasons
    FROM ({_CHECKED}) WHERE NOT ({_ALL})"""


def _contacts(spark, folder):
    return table(spark, folder, "customer").selectExpr("c_custkey", *_CONTACT_COLUMNS)


_CONTACT_COLUMNS = (
    """CASE WHEN c_mktsegment = 'MACHINERY' THEN replace(c_name, '#', ' at ')
            WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL
            ELSE concat(lower(replace(c_name, '#', '.')), '@example.com') END AS customer_email""",
    """CASE c_mktsegment WHEN 'FURNITURE' THEN concat('+64', CAST(20000000 + c_custkey AS STRING))
            WHEN 'BUILDING' THEN concat('0', CAST(30000000 + c_custkey AS STRING))
            WHEN 'AUTOMOBILE' THEN concat('+1', CAST(40000000 + c_custkey AS STRING))
            ELSE CAST(c_custkey AS STRING) END AS phone_number""")
CONTACTS = f"SELECT c_custkey, {_CONTACT_COLUMNS[0]}, {_CONTACT_COLUMNS[1]} FROM customer"


def _customer_rules(spark, folder):
    tagged = quality.expect(_contacts(spark, folder), quality.customer_rules(), "warn")
    return tagged.withColumn("failure_reasons", F.array_join("failure_reasons", "|"))


CUSTOMER_RULES_SQL = f"""
    WITH checked AS (
        SELECT *, coalesce(customer_email LIKE '%@%.%', false) AS r1,
               coalesce(regexp_matches(phone_number, '^([+]64|0)[2-9][0-9]{{7,9}}$'), false) AS r2
        FROM ({CONTACTS}))
    SELECT c_custkey, customer_email, phone_number, r1 AND r2 AS is_valid,
           concat_ws('|', CASE WHEN NOT r1 THEN 'valid_email' END, CASE WHEN NOT r2 THEN 'nz_phone_format' END)
               AS failure_reasons
    FROM checked"""


def _metrics(spark, folder):
    return quality.metrics(_typed(spark, folder), RULES, "tx_time")


METRICS_SQL = " UNION ALL ".join(
    f"""SELECT '{name}' AS rule, count(*) AS total_rows, count(*) FILTER (NOT ({check})) AS failed_rows,
               round(1 - CAST(count(*) FILTER (NOT ({check})) AS DOUBLE) / count(*), 6) AS pass_rate,
               max(tx_time) AS latest_event
        FROM ({_CHECKED})"""
    for name, check in [*zip(RULES, ("r1", "r2", "r3", "r4", "r5")), ("ALL", _ALL)])


def _batch_counts(spark, folder):
    return quality.apply_rules(_typed(spark, folder), RULES).agg(*quality.batch_metrics())


def _lags(spark, folder):
    """A line arrives as many seconds after it was shipped as its price has units."""
    seconds = F.floor("l_extendedprice").cast("long")
    return table(spark, folder, "lineitem").select(
        "l_returnflag", "l_linenumber", "l_shipdate", (F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18, 6)"))).alias("arrived"), (seconds * 1000).alias("lag"))


def _freshness(spark, folder):
    # Seven batches leave their sketches in a table; its rows are merged, and the quantiles are held against the exact ranks.
    lags, name = _lags(spark, folder), f"{scratch_schema(spark, 'fresh')}.lags"
    for batch in range(1, 8):
        part = lags.filter(F.col("l_linenumber") == batch)
        tables.append_batch(spark, freshness.sketch_lags(part, "l_shipdate", "arrived", ["l_returnflag"]), name, batch)
    found = freshness.quantiles(tables.read(spark, name), ["l_returnflag"])
    limits = found.groupBy("l_returnflag").agg(*[
        F.max(F.when(F.col("rank") == r, F.col("lag"))).alias(f"q{i}") for i, r in enumerate(freshness.RANKS)])
    exact = lags.join(limits, "l_returnflag").groupBy("l_returnflag").agg(
        *[F.struct(F.avg((F.col("lag") < F.col(f"q{i}")).cast("int")).alias("below"),
                   F.avg((F.col("lag") <= F.col(f"q{i}")).cast("int")).alias("upto")).alias(f"e{i}")
          for i in range(len(freshness.RANKS))])
    ranks = F.explode(F.array(*[F.struct(F.lit(r).alias("rank"), F.col(f"e{i}.below").alias("below"),
                                         F.col(f"e{i}.upto").alias("upto")) for i, r in enumerate(freshness.RANKS)]))
    ranks = exact.select("l_returnflag", ranks.alias("e")).select("l_returnflag", "e.*")
    close = (F.col("below") <= F.col("rank") + 0.02) & (F.col("upto") >= F.col("rank") - 0.02)
    return found.join(ranks, ["l_returnflag", "rank"]).select(
        "l_returnflag", "rank", F.col("rows").alias("n"), "least", "greatest", "latest_event", close.alias("close"))


FRESHNESS_SQL = """
    SELECT l_returnflag, rank, count(*) AS n, min(1000 * CAST(floor(l_extendedprice) AS BIGINT)) AS least,
           max(1000 * CAST(floor(l_extendedprice) AS BIGINT)) AS greatest, max(l_shipdate) AS latest_event, true AS close
    FROM lineitem, (SELECT unnest([0.5, 0.95, 0.99])::DOUBLE AS rank) GROUP BY l_returnflag, rank"""


def _audit(spark, folder):
    return with_audit(table(spark, folder, "orders"), "nightly", "local", "tester", "2024-01-01 00:00:00")


QUERIES = {
    "conform_types": (_typed, _TYPED),
    "quality_valid": (_valid, f"SELECT tx_id, amount, region, tx_time FROM ({_CHECKED}) WHERE {_ALL}"),
    "quality_enforced": (_dropped, f"SELECT tx_id, amount, region, tx_time FROM ({_CHECKED}) WHERE {_ALL}"),
    "quality_quarantine": (_quarantine, QUARANTINE_SQL),
    "customer_rules": (_customer_rules, CUSTOMER_RULES_SQL),
    "quality_metrics": (_metrics, METRICS_SQL),
    "quality_batch_counts": (_batch_counts, f"""
        SELECT count(*) FILTER ({_ALL}) AS valid_rows, count(*) FILTER (NOT ({_ALL})) AS quarantined_rows
        FROM ({_CHECKED})"""),
    "freshness_quantiles": (_freshness, FRESHNESS_SQL),
    "audit_columns": (_audit, """
        SELECT *, 'nightly' AS _pipeline_run_id, '2024-01-01 00:00:00' AS _processed_at, 'local' AS _run_mode,
               'tester' AS _user
        FROM orders"""),
}
