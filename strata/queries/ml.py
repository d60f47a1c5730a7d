"""Feature preparation, training, scoring and evaluation."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.ml import churn
from strata.plans import reports
from strata.queries.inputs import CHURN, customers, scratch_schema, table, transactions
from strata.session import shared_dir
from strata.sources import tables

NUMBERS = ("tenure_months", "support_tickets", "total_lifetime_spend", "avg_tx_value", "frequency_score")


def _features(spark, folder):
    return reports.churn_features(customers(spark, folder), transactions(spark, folder))


def _index(spark, folder):
    df = _features(spark, folder)
    model = churn.index_categories(["tier"]).fit(df)
    return model.transform(df).select("customer_id", "tier", "tier_index")


_RANKED = f"""
    SELECT tier, row_number() OVER (ORDER BY count(*) DESC, tier) - 1 AS rank, count(*) OVER () AS tiers
    FROM ({CHURN}) GROUP BY tier"""
INDEX_SQL = f"""
    SELECT customer_id, tier, CAST(rank AS DOUBLE) AS tier_index FROM ({CHURN}) JOIN ({_RANKED}) USING (tier)"""


def _one_hot(spark, folder):
    df = _features(spark, folder)
    stages = [churn.index_categories(["tier"]), churn.one_hot(["tier"])]
    vectors = Pipeline(stages=stages).fit(df).transform(df)
    slots = F.transform(vector_to_array("tier_vec"), lambda x: x.cast("int").cast("string"))
    return vectors.select("customer_id", F.array_join(slots, "").alias("slots"))


# One slot per tier and one more for unseen values.
ONE_HOT_SQL = f"""
    SELECT customer_id, repeat('0', CAST(rank AS INTEGER)) || '1' || repeat('0', CAST(tiers - rank AS INTEGER))
           AS slots
    FROM ({CHURN}) JOIN ({_RANKED}) USING (tier)"""


def _scale(spark, folder):
    df = churn.prepared(_features(spark, folder), NUMBERS)
    scaled = Pipeline(stages=churn.feature_pipeline(NUMBERS, [])).fit(df).transform(df)
    values = vector_to_array("features")
    return scaled.select("customer_id", *[F.round(values[i], 6).alias(c) for i, c in enumerate(NUMBERS)])


SCALE_SQL = "SELECT customer_id, " + ", ".join(
    f"round(coalesce({c}, 0) / stddev_samp(coalesce({c}, 0)) OVER (), 6) AS {c}" for c in NUMBERS) + f" FROM ({CHURN})"


def _split(spark, folder):
    return customers(spark, folder).select(
        "customer_id", churn.in_training("customer_id").alias("train_80"),
        churn.in_training("customer_id", 7).alias("train_70"))


_HASH = "CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 10"
SPLIT_SQL = f"""
    SELECT c_custkey AS customer_id, {_HASH} < 8 AS train_80, {_HASH} < 7 AS train_70
    FROM (SELECT c_custkey FROM customer UNION ALL SELECT -1 - s_suppkey FROM supplier)"""


def _feature_table(spark, folder):
    """The features as a gold table, which training reads many times."""
    name = f"{scratch_schema(spark, 'ml')}.churn_features"
    tables.replace(spark, _features(spark, folder), name)
    return tables.read(spark, name)


def _score(spark, folder):
    # The model goes through storage, as a scoring job would get it.
    path, features = shared_dir(spark, "model"), _feature_table(spark, folder)
    churn.save(churn.train(features).model, path)
    scored = churn.score(churn.load(path), features).withColumn("p", vector_to_array("probability"))
    # What the forest answers is its own; that every row has one consistent answer can be stated.
    return scored.select(
        "customer_id", "is_churned", ((F.col("prediction") == 1) == (F.col("p")[1] > F.col("p")[0])).alias("agrees"),
        (F.col("p")[1].between(0, 1) & (F.abs(F.col("p")[0] + F.col("p")[1] - 1) < 1e-9)).alias("is_probability"))


SCORE_SQL = f"SELECT customer_id, is_churned, true AS agrees, true AS is_probability FROM ({CHURN})"


def _importances(spark, folder):
    features = _feature_table(spark, folder)
    weights = churn.importances(churn.train(features, trees=20).model, features)
    # One row per vector slot.
    total = F.sum("importance").over(Window.partitionBy(F.lit(1)))
    return weights.select("feature", "source_column", F.col("importance").between(0, 1).alias("is_share"),
                          (F.abs(total - 1) < 1e-9).alias("sums_to_one"))


_KEY_HASH = "CAST('0x' || substr(md5(CAST(customer_id AS VARCHAR)), 1, 8) AS BIGINT) % 10"
# One slot per number, per tier of the training rows, and for unseen tiers.
IMPORTANCES_SQL = f"""
    SELECT feature, source_column, true AS is_share, true AS sums_to_one FROM (
        SELECT unnest([{", ".join(f"'{c}'" for c in NUMBERS)}]) AS feature, feature AS source_column
        UNION ALL SELECT DISTINCT 'tier_vec_' || tier, 'tier' FROM ({CHURN})
                  WHERE {_KEY_HASH} < 8 AND is_churned IS NOT NULL
        UNION ALL SELECT 'tier_vec___unknown', 'tier')"""


def _run_log(spark, folder):
    name, features = f"{scratch_schema(spark, 'ml')}.model_runs", _feature_table(spark, folder)
    for trees in (5, 10):
        trained = churn.train(features, trees=trees, tenths=7, drop_last=True)
        churn.log_run(spark, trained, f"churn_{trees}", "gold_ml.churn_features", table=name)
    return spark.table(name).drop("logged_at").withColumn("auc", F.col("auc").between(0, 1))


RUN_LOG_SQL = f"""
    SELECT 'churn_' || trees AS run_name, 'gold_ml.churn_features' AS table_name, trees AS num_trees,
           count(*) FILTER ({_KEY_HASH} < 7) AS train_rows, count(*) FILTER ({_KEY_HASH} >= 7) AS test_rows,
           {len(NUMBERS) + 1} AS feature_columns, true AS auc
    FROM ({CHURN}), (SELECT unnest([5, 10]) AS trees) WHERE is_churned IS NOT NULL GROUP BY trees"""


def _auc(spark, folder):
    # How well a document's length tells its quality label.
    scored = table(spark, folder, "labels").join(table(spark, folder, "documents"), "doc_id").select(
        "quality", (F.col("n_chars") / (F.col("n_chars") + 1000)).alias("score"))
    return churn.auc(scored, "quality", "score").withColumn("auc", F.round("auc", 6))


AUC_SQL = """
    WITH scored AS (
        SELECT quality, CAST(n_chars AS DOUBLE) / (n_chars + 1000) AS score
        FROM labels JOIN documents USING (doc_id)),
    ranked AS (
        SELECT quality, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r
        FROM scored)
    SELECT round((CAST(sum(r) FILTER (quality = 1) AS DOUBLE)
                  - count(*) FILTER (quality = 1) * (count(*) FILTER (quality = 1) + 1) / 2.0)
                 / (CAST(count(*) FILTER (quality = 1) AS DOUBLE) * count(*) FILTER (quality = 0)), 6) AS auc,
           count(*) FILTER (quality = 1) AS positives, count(*) FILTER (quality = 0) AS negatives
    FROM ranked"""

QUERIES = {
    "ml_index": (_index, INDEX_SQL),
    "ml_one_hot": (_one_hot, ONE_HOT_SQL),
    "ml_scale": (_scale, SCALE_SQL),
    "ml_split": (_split, SPLIT_SQL),
    "ml_score": (_score, SCORE_SQL),
    "ml_importances": (_importances, IMPORTANCES_SQL),
    "ml_run_log": (_run_log, RUN_LOG_SQL),
    "ml_auc": (_auc, AUC_SQL),
}
