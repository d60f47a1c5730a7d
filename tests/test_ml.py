"""Feature typing, splits, training, rating."""

import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from strata.ml import churn
from strata.queries.inputs import scratch_schema


@pytest.fixture(scope="module")
def features(spark):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        tickets, tier = rng.randint(0, 9), rng.choice(["Gold", "Silver", "Bronze"])
        spend = rng.random() * 100 if i % 7 else None
        rows.append((f"C{i}", rng.randint(1, 60), tickets, tier, int(tickets > 5), spend, spend, rng.randint(0, 9)))
    return spark.createDataFrame(rows, "customer_id STRING, tenure_months INT, support_tickets INT, tier STRING, "
                                       "is_churned INT, total_lifetime_spend DOUBLE, avg_tx_value DOUBLE, "
                                       "frequency_score LONG")


@pytest.fixture(scope="module")
def trained(features):
    return churn.train(features, trees=10)


def test_columns_are_typed_without_label_and_ids(features):
    assert churn.feature_columns(features) == (
        ["tenure_months", "support_tickets", "total_lifetime_spend", "avg_tx_value", "frequency_score"], ["tier"])


def test_rare_categories_share_the_slot_of_unseen_ones(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 1000, "b").when(F.col("id") < 1900, "a").otherwise(
        F.col("id").cast("string")).alias("name"))
    index = churn.frequent_categories(df, ["name"], most=3)
    assert index.labels == ["b", "a", "1900"]
    found = {r.name: r.name_index for r in index.transform(df.unionByName(df.limit(1).selectExpr("'z' AS name"))).collect()}
    assert found["b"] == 0 and found["a"] == 1 and found["1900"] == 2
    assert {v for k, v in found.items() if k not in ("a", "b", "1900")} == {3.0}


def test_all_categories_index_as_the_plain_indexer_does(spark, features):
    with_null = features.unionByName(features.limit(2).withColumn("tier", F.lit(None).cast("string")))
    plain = churn.index_categories(["tier"]).fit(with_null)
    assert churn.frequent_categories(with_null, ["tier"]).labels == plain.labels


def test_unseen_categories_have_a_bucket_or_a_zero_vector(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",)], "tier STRING")
    new = spark.createDataFrame([("a",), ("b",), ("z",)], "tier STRING")
    for drop_last, last in ((False, [0.0, 0.0, 1.0]), (True, [0.0, 0.0])):
        model = Pipeline(stages=[churn.index_categories(["tier"]), churn.one_hot(["tier"], drop_last)]).fit(train)
        rows = model.transform(new).select("tier_index", vector_to_array("tier_vec").alias("x")).collect()
        assert [r.tier_index for r in rows] == [0.0, 1.0, 2.0]
        assert rows[2].x == last


def test_split_depends_on_the_key_only(features):
    train, test = churn.split(features)
    again = churn.split(features.repartition(13))[0]
    assert train.count() + test.count() == 400
    assert 0.7 < train.count() / 400 < 0.9
    assert {r[0] for r in train.select("customer_id").collect()} == {r[0] for r in again.select("customer_id").collect()}


def test_model_learns_and_survives_storage(trained, features, folder):
    assert trained.auc > 0.95 and trained.train_rows + trained.test_rows == 400
    churn.save(trained.model, f"{folder}/model")
    again = churn.score(churn.load(f"{folder}/model"), features)
    first = churn.score(trained.model, features)
    columns = ["customer_id", "prediction", "probability"]
    assert again.select(columns).orderBy("customer_id").collect() == first.select(columns).orderBy("customer_id").collect()


def test_hand_written_records_are_scored(spark, trained):
    rows = [("T1", 2, 9, "Bronze", 45.5, 22.75, 2), ("T2", 48, 1, "Platinum", None, None, 0)]
    df = spark.createDataFrame(rows, "customer_id STRING, tenure_months INT, support_tickets INT, tier STRING, "
                                     "total_lifetime_spend DOUBLE, avg_tx_value DOUBLE, frequency_score LONG")
    scored = {r.customer_id: r.prediction for r in churn.score(trained.model, df).collect()}
    assert scored == {"T1": 1.0, "T2": 0.0}


def test_importances_carry_the_right_names(trained, features):
    rows = churn.importances(trained.model, features).collect()
    assert len(rows) == 5 + 4
    assert abs(sum(r.importance for r in rows) - 1) < 1e-9
    assert max(rows, key=lambda r: r.importance).feature == "support_tickets"
    assert {r.source_column for r in rows if r.feature.startswith("tier")} == {"tier"}


def test_runs_are_logged(spark, trained):
    name = f"{scratch_schema(spark, 'runs')}.model_runs"
    for run in ("one", "two"):
        churn.log_run(spark, trained, run, "t", "2024-01-01", table=name)
    rows = spark.table(name).orderBy("run_name").collect()
    assert [r.run_name for r in rows] == ["one", "two"] and rows[0].num_trees == 10 and rows[0].auc == trained.auc


@pytest.mark.parametrize("distinct", [3, 1000])
def test_auc_equals_the_evaluator(spark, distinct):
    rng = random.Random(distinct)
    rows = [(int(rng.random() < 0.3), rng.randint(-distinct, distinct * 2) / distinct) for _ in range(2000)]
    df = spark.createDataFrame(rows, "label INT, score DOUBLE")
    ours = churn.auc(df, "label", "score", buckets=16).first()
    theirs = BinaryClassificationEvaluator(rawPredictionCol="v", labelCol="label", numBins=0).evaluate(
        df.select(F.col("label").cast("double"), array_to_vector(F.array(-F.col("score"), "score")).alias("v")))
    assert abs(ours.auc - theirs) < 1e-9
    assert ours.positives + ours.negatives == 2000


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.5)], "label INT, score DOUBLE")
    assert churn.auc(df, "label", "score").first().auc is None
    assert churn.auc(df.filter("false"), "label", "score").first().auc is None


def test_close_scores_spread_over_the_buckets(spark):
    # All scores between 5 and 5.001, a third of the rows with one of them.
    df = spark.range(3000).select(
        F.pmod(F.xxhash64("id"), F.lit(2)).cast("int").alias("label"),
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(5 + F.col("id") / 3_000_000).alias("score"))
    rated = churn.auc(df, "label", "score", buckets=16)
    pairs = [tuple(r) for r in df.collect()]
    up, down = [s for y, s in pairs if y], [s for y, s in pairs if not y]
    wins = sum((a > b) + (a == b) / 2 for a in up for b in down)
    assert abs(rated.first().auc - wins / len(up) / len(down)) < 1e-9
