"""Rules, quarantine, policies and metrics."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strata.functions.audit import AUDIT_COLUMNS, with_audit
from strata.operators import quality


@pytest.fixture
def tx(spark):
    return spark.createDataFrame([
        ("a", 1.0, "AUCKLAND", "2024-01-01"), (None, 1.0, "AUCKLAND", "2024-01-01"),
        ("c", -99.99, "WELLINGTON", "2024-01-01"), ("d", None, None, "2024-01-01"),
        ("e", 5.0, "TAURANGA", "2999-01-01")], "tx_id STRING, amount DOUBLE, region STRING, tx_time STRING")


RULES = quality.transaction_rules(now="'2025-01-01'")


def reasons(df):
    return {r.tx_id: (list(r.failure_reasons), r.is_valid) for r in df.collect()}


def test_all_failed_rules_are_named_and_null_counts_as_failed(tx):
    assert reasons(quality.apply_rules(tx, RULES)) == {
        "a": ([], True), None: (["valid_id"], False), "c": (["positive_amount"], False),
        "d": (["positive_amount", "known_region"], False), "e": (["known_region", "future_date_check"], False)}


def test_listed_rules_name_themselves(tx):
    found = reasons(quality.apply_rules(tx, ["amount > 0", "tx_id IS NOT NULL"]))
    assert found["c"] == (["amount > 0"], False) and found[None] == (["tx_id IS NOT NULL"], False)


def test_no_rules_means_valid(tx):
    rows = quality.apply_rules(tx, []).collect()
    assert all(r.is_valid and r.failure_reasons is None for r in rows)
    assert quality.quarantined_rows(tx, {}).count() == 0


def test_split_is_complete_and_disjoint(tx):
    good, bad = quality.split(quality.apply_rules(tx, RULES))
    assert (good.count(), bad.count()) == (1, 4)
    assert good.columns == tx.columns
    assert quality.valid_rows(tx, RULES).collect() == good.collect()
    assert sorted(map(str, quality.quarantined_rows(tx, RULES).collect())) == sorted(map(str, bad.collect()))
    assert "_quarantine_at" in quality.quarantine(quality.apply_rules(tx, RULES)).columns


def test_stock_clock_is_the_current_time(tx):
    found = reasons(quality.apply_rules(tx, quality.transaction_rules()))
    assert found["a"] == ([], True) and "future_date_check" in found["e"][0]


def test_policies(tx):
    assert quality.expect(tx, RULES, "warn").count() == 5
    assert quality.expect(tx, RULES, "drop").count() == 1
    with pytest.raises(PySparkException, match="valid_id|positive_amount|known_region|future_date"):
        quality.expect(tx, RULES, "fail").count()
    assert quality.expect(quality.expect(tx, RULES, "drop"), RULES, "fail").count() == 1
    with pytest.raises(ValueError):
        quality.expect(tx, RULES, "ignore")


def test_customer_rules(spark):
    df = spark.createDataFrame([
        ("a@b.nz", "+6421123456"), ("a@b", "0211234567"), (None, "021123456789012"), ("x@y.z", "0111234567")],
        "customer_email STRING, phone_number STRING")
    found = [(list(r.failure_reasons)) for r in quality.apply_rules(df, quality.customer_rules()).collect()]
    assert found == [[], ["valid_email"], ["valid_email", "nz_phone_format"], ["nz_phone_format"]]


def test_metrics_in_one_row_per_rule(tx):
    rows = {r.rule: r for r in quality.metrics(tx, RULES, "tx_time").collect()}
    assert (rows["ALL"].total_rows, rows["ALL"].failed_rows, rows["ALL"].pass_rate) == (5, 4, 0.2)
    assert rows["known_region"].failed_rows == 2 and rows["ALL"].latest_event == "2999-01-01"
    empty = quality.metrics(tx.filter("false"), RULES).collect()
    assert all(r.total_rows == 0 and r.pass_rate is None for r in empty)
    counts = quality.apply_rules(tx, RULES).agg(*quality.batch_metrics()).first()
    assert (counts.valid_rows, counts.quarantined_rows) == (1, 4)


def test_audit_columns_are_repeatable(tx):
    stamp = "2024-01-01 00:00:00"
    one, two = (with_audit(tx, "run", "local", None, stamp).collect() for _ in range(2))
    assert one == two
    assert with_audit(tx, "run").columns[-4:] == list(AUDIT_COLUMNS)
    assert with_audit(tx, "run", user="u").filter(F.col("_user") == "u").count() == 5
