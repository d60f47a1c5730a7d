from strata.queries import registry
"""The plans are the ones meant for large data."""

import __spark_entry__ as contract
import pytest
from pyspark.sql import functions as F

from strata.operators import gold, quality
from strata.operators.adjacent import adjacent
from strata.sources import files

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_summed_join_shuffles_each_side_once(spark, no_broadcast):
    left = spark.read.parquet(f"{FOLDER}/customer.parquet").withColumnRenamed("c_custkey", "k")
    right = spark.read.parquet(f"{FOLDER}/orders.parquet").withColumnRenamed("o_custkey", "k")
    df = gold.join_aggregate(left, right, "k", "left", ["k", "c_mktsegment"], {"s": "sum(o_totalprice)"})
    text = plan(df)
    assert text.count("Exchange hashpartitioning") == 2
    assert text.index("Exchange hashpartitioning") < text.rindex("partial_sum(o_totalprice")
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in text


def test_chunked_window_shuffles_the_long_side_once(spark, no_broadcast):
    events = spark.read.parquet(f"{FOLDER}/events.parquet").select("user_id", "ts", "event_id", "event_type")
    # No user has a million events: one plain window.
    assert plan(adjacent(events, ["user_id"], ["ts", "event_id"], F.col("event_type"), "p")).count("Exchange hash") == 1
    text = plan(adjacent(events, ["user_id"], ["ts", "event_id"], F.col("event_type"), "p", unit="day"))
    # The rows, the rows again from the same shuffle, and the few border rows.
    assert text.count("Exchange hashpartitioning") == 3 and text.count("ReusedExchange") == 1
    assert "Join" not in text and text.count("FileScan") == 1


def test_rules_reach_the_scan(spark):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    rules = ["o_totalprice > 0", "o_orderstatus IN ('F', 'O')"]
    for df in (quality.valid_rows(orders, rules), quality.expect(orders, rules, "drop")):
        assert "GreaterThan(o_totalprice,0.0), In(o_orderstatus, [F,O])" in plan(df)
    tagged = plan(quality.apply_rules(orders, rules).select("o_orderkey", "is_valid", "failure_reasons"))
    assert "*(1) Project" in tagged and "array_remove" in tagged


def test_small_reads_stay_small(spark, folder):
    # Size and name filters drop files while listing.
    for name, size in (("small.csv", 5), ("large.csv", 5000), ("data.parquet", 5000)):
        with open(f"{folder}/{name}", "w") as out:
            out.write("x" * size)

    def read(df):
        df.collect()
        leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        return leaf.metrics().apply("numFiles").value()

    assert read(files.whole_files(spark, folder, max_bytes=100).select("payload")) == 2
    assert read(files.typed_file_names(spark, folder)) == 1
    lines = spark.read.text(folder).filter("_metadata.file_size > 100 AND _metadata.file_name LIKE '%.csv'")
    assert read(lines) == 1


def test_contract(spark):
    df = contract.entry(spark)
    assert df.columns == ["region", "report_month", "total_revenue", "transaction_count", "prev_month_revenue",
                          "mom_growth_pct"]
    names, oracles = contract.queries(), contract.oracle_sql()
    assert set(oracles) <= set(names)
    assert set(registry()) <= set(oracles)
