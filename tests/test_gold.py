"""Joins, aggregates, sorts and the standard reports."""

import datetime

import pytest

from strata.operators import gold
from strata.plans import reports


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [(1, "x", "L1"), (2, "y", "L2"), (3, "z", "L3"), (None, "n", "L4"), (1, "x", "L1")],
        "id INT, tier STRING, status STRING")


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(
        [(1, 10.0, "a", "R"), (1, 30.0, None, "R"), (2, None, "b", "R"), (9, 5.0, "c", "R"), (None, 7.0, "d", "R")],
        "id INT, amount DOUBLE, tx STRING, status STRING")


AGGREGATES = {"total": "sum(amount)", "mean": "avg( amount )", "n": "COUNT(tx)", "low": "min(amount)",
              "high": "max(tx)"}


def as_sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("how", ["left", "inner", "left_outer"])
def test_summing_before_the_join_changes_nothing(people, sales, how):
    groups = ["id", "tier", "status"]
    direct = gold.aggregate(gold.join(people, sales, "id", how), groups, AGGREGATES)
    eager = gold.join_aggregate(people, sales, "id", how, groups, AGGREGATES)
    assert eager.schema == direct.schema or [f.dataType for f in eager.schema] == [f.dataType for f in direct.schema]
    assert as_sorted(eager) == as_sorted(direct)
    assert "_sum_amount" in eager._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("how, groups, aggregates", [
    ("right", ["id"], {"n": "count(tx)"}),
    ("left", ["id"], {"n": "count(*)"}),
    ("left", ["id"], {"n": "count(tier)"}),
    ("left", ["tx"], {"n": "count(amount)"}),
    ("left", ["id"], {"n": "count(distinct tx)"}),
    ("left", ["id"], {"n": "sum(amount * 2)"}),
    ("left", [], {"n": "count(tx)"}),
])
def test_other_shapes_join_first(people, sales, how, groups, aggregates):
    direct = gold.aggregate(gold.join(people, sales, "id", how), groups, aggregates)
    assert as_sorted(gold.join_aggregate(people, sales, "id", how, groups, aggregates)) == as_sorted(direct)


def test_left_columns_win_and_key_is_kept_once(people, sales):
    joined = gold.join(people, sales, "id")
    assert joined.columns == ["id", "tier", "status", "amount", "tx"]
    assert {r.status for r in joined.collect()} == {"L1", "L2"}


def test_skewed_left_join_equals_left_join(people, sales):
    plain, skewed = gold.join(people, sales, "id", "left"), gold.join(people, sales, "id", "left", skewed=True)
    assert skewed.columns == plain.columns
    assert as_sorted(skewed) == as_sorted(plain)


def test_optional_and_missing_tables(people, sales):
    named = {"sales": sales}
    joins = [{"table": "none", "on": "id", "optional": True}, {"table": "sales", "on": "id", "type": "left_anti"}]
    left = gold.join_tables(people, joins, named.get, named.__contains__)
    assert {r.id for r in left.collect()} == {3, None}
    with pytest.raises(KeyError):
        gold.join_tables(people, [{"table": "none", "on": "id"}], named.__getitem__, named.__contains__)


def test_global_aggregate_and_order(people, sales):
    assert gold.aggregate(sales, [], {"n": "count(tx)"}).collect() == [(4,)]
    assert [r.id for r in gold.sort(people.dropna(), "status").collect()] == [3, 2, 1, 1]
    assert [r.id for r in gold.sort(people.dropna(), ["id", "status"], ascending=True).collect()] == [1, 1, 2, 3]
    assert [r.id for r in gold.top_n(people, "id", 2).collect()] == [3, 2]


def test_growth_over_gaps_and_zero_months(spark):
    rows = [("N", 10.0, "2024-01-05"), ("N", 10.0, "2024-01-06"), ("N", 0.0, "2024-03-01"), ("N", 5.0, "2024-04-01"),
            ("S", 1.0, "2024-01-01")]
    tx = spark.createDataFrame(
        [(f"t{i}", a, r, datetime.datetime.fromisoformat(t)) for i, (r, a, t) in enumerate(rows)],
        "tx_id STRING, amount DOUBLE, region STRING, tx_time TIMESTAMP_NTZ")
    found = {(r.region, r.report_month.month): (r.total_revenue, r.transaction_count, r.prev_month_revenue,
                                                r.mom_growth_pct) for r in reports.monthly_revenue(tx).collect()}
    assert found == {("N", 1): (20.0, 2, None, None), ("N", 3): (0.0, 1, 20.0, -100.0), ("N", 4): (5.0, 1, 0.0, None),
                     ("S", 1): (1.0, 1, None, None)}
    reports.create_monthly_revenue_view(tx, "mr")
    assert spark.sql("SELECT count(*) FROM mr").first()[0] == 4


def test_text_times_work_in_the_monthly_report(spark):
    tx = spark.createDataFrame([("t", 1.0, "N", "2024-02-03T10:00:00")],
                               "tx_id STRING, amount DOUBLE, region STRING, tx_time STRING")
    assert str(reports.monthly_revenue(tx).first().report_month).startswith("2024-02-01")


def test_churn_features_of_a_customer_without_transactions(spark):
    customers = spark.createDataFrame([(1, 3, 0, "Gold", 0), (2, 4, 1, "Silver", 1)],
                                      "customer_id INT, tenure_months INT, support_tickets INT, tier STRING, "
                                      "is_churned INT")
    tx = spark.createDataFrame([("a", 1, 2.0), ("b", 1, 4.0)], "tx_id STRING, customer_id INT, amount DOUBLE")
    rows = {r.customer_id: r for r in reports.churn_features(customers, tx).collect()}
    assert (rows[1].total_lifetime_spend, rows[1].avg_tx_value, rows[1].frequency_score) == (6.0, 3.0, 2)
    assert (rows[2].total_lifetime_spend, rows[2].avg_tx_value, rows[2].frequency_score) == (None, None, 0)


@pytest.mark.parametrize("kind", ["DECIMAL(18,6)", "DECIMAL(10,2)", "DECIMAL(9,0)", "INT", "DOUBLE"])
def test_averages_before_the_join_equal_those_after_it(spark, kind):
    left = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'a'), (3, 'b') AS t(k, g)")
    right = spark.sql(f"""SELECT k, CAST(v AS {kind}) AS v
                          FROM VALUES (1, 0.000001), (1, 0.000002), (2, 0.000002), (2, 1), (3, 7), (3, 2) AS t(k, v)""")
    found = gold.join_aggregate(left, right, "k", "left", ["g"], {"m": "avg(v)"})
    plain = gold.aggregate(gold.join(left, right, "k", "left"), ["g"], {"m": "avg(v)"})
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))
