"""Features, training, scoring and evaluation of the churn classifier on Spark ML."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import (
    Bucketizer, OneHotEncoder, StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler)
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType)
from pyspark.storagelevel import StorageLevel

from strata.sources import tables

NUMERIC = (ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType, DecimalType)
LABEL, ID = "is_churned", "customer_id"
# Values of a text column that get a vector slot of their own, by default: the most frequent ones. All rarer values
# share the slot of unseen values.
MAX_CATEGORIES = 1000


def feature_columns(df: DataFrame, label: str = LABEL, ids: Sequence[str] = (ID,)) -> tuple[list[str], list[str]]:
    """The numeric and the categorical (text) feature columns; label and ids are neither."""
    fields = [f for f in df.schema.fields if f.name != label and f.name not in ids]
    return ([f.name for f in fields if isinstance(f.dataType, NUMERIC)],
            [f.name for f in fields if isinstance(f.dataType, StringType)])


def frequent_categories(df: DataFrame, columns: Sequence[str], most: int = MAX_CATEGORIES) -> StringIndexerModel:
    """The index of :func:`index_categories` over each column's ``most`` most frequent values.

    Values are counted in the cluster and only those that get an index come to the driver, so identifiers and other
    columns of any number of values can be trained on.
    """
    labels = []
    for c in columns:
        counts = df.filter(F.col(c).isNotNull()).groupBy(F.col(c).alias("value")).count()
        labels.append([r["value"] for r in counts.orderBy(F.desc("count"), "value").limit(most).collect()])
    return StringIndexerModel.from_arrays_of_labels(labels, list(columns), [f"{c}_index" for c in columns], "keep")


def index_categories(columns: Sequence[str]) -> StringIndexer:
    """Most frequent value first, ties by name; an unseen value gets a bucket of its own."""
    return StringIndexer(inputCols=list(columns), outputCols=[f"{c}_index" for c in columns], handleInvalid="keep")


def one_hot(columns: Sequence[str], drop_last: bool = False) -> OneHotEncoder:
    """With ``drop_last`` an unseen value is the all-zero vector."""
    return OneHotEncoder(inputCols=[f"{c}_index" for c in columns], outputCols=[f"{c}_vec" for c in columns],
                         dropLast=drop_last)


def assemble(numeric: Sequence[str], categorical: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=[*numeric, *[f"{c}_vec" for c in categorical]], outputCol="raw_features")


def scale() -> StandardScaler:
    """To unit standard deviation, without centring."""
    return StandardScaler(inputCol="raw_features", outputCol="features")


def prepared(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """Numbers as doubles, with 0 for NULL: the assembler rejects NULLs (a customer without transactions)."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numeric})


def feature_pipeline(numeric: Sequence[str], categorical: Sequence[str], drop_last: bool = False) -> list:
    encoders = [index_categories(categorical), one_hot(categorical, drop_last)] if categorical else []
    return [*encoders, assemble(numeric, categorical), scale()]


def in_training(key: str, tenths: int = 8) -> Column:
    """A repeatable split by key: the leading 32 bits of its MD5, modulo ten. Unlike a random split it does not
    depend on how rows are partitioned."""
    head = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long")
    return head % 10 < tenths


def split(df: DataFrame, key: str = ID, tenths: int = 8) -> tuple[DataFrame, DataFrame]:
    """Training and test rows (8 of ten by default, 7 for a 70/30 split)."""
    return df.filter(in_training(key, tenths)), df.filter(~in_training(key, tenths))


@dataclass
class Trained:
    model: PipelineModel
    scored: DataFrame
    auc: float
    train_rows: int
    test_rows: int
    feature_count: int


def train(df: DataFrame, label: str = LABEL, key: str = ID, trees: int = 10, seed: int = 42, tenths: int = 8,
          drop_last: bool = False, max_categories: int = MAX_CATEGORIES) -> Trained:
    """Fit index, one-hot, assemble, scale and random forest on the training rows; score and rate the test rows.

    ``max_categories``: how many values of a text column get a vector slot of their own (:func:`frequent_categories`).
    """
    numeric, categorical = feature_columns(df, label, (key,))
    forest = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=trees, seed=seed)
    # The fit passes over the rows many times, and rating them once more.
    rows = prepared(df, numeric).filter(F.col(label).isNotNull()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fit_rows, test_rows = split(rows, key, tenths)
        stages = feature_pipeline(numeric, categorical, drop_last)
        if categorical:
            stages[0] = frequent_categories(fit_rows, categorical, max_categories)
        model = Pipeline(stages=[*stages, forest]).fit(fit_rows)
        scored = score(model, test_rows)
        result = auc(scored.select(label, churn_probability().alias("p")), label, "p").first()
        return Trained(model, scored, result["auc"], fit_rows.count(), result["positives"] + result["negatives"],
                       len(numeric) + len(categorical))
    finally:
        rows.unpersist()


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``probability`` and ``prediction``. NULL numbers count as 0, as in training."""
    inputs = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    return model.transform(prepared(df, [c for c in inputs if not c.endswith("_vec")]))


def churn_probability() -> Column:
    from pyspark.ml.functions import vector_to_array
    return vector_to_array("probability")[1]


def auc(scored: DataFrame, label: str, score_column: str, buckets: int = 1024) -> DataFrame:
    """Area under the ROC curve by rank sums, ties averaged: ``auc``, ``positives``, ``negatives``.

    Rows are first counted per distinct score. Ranks are then running counts: within score buckets in parallel, and
    over the at most ``buckets`` bucket totals. Buckets are cut at quantiles of the distinct scores, so scores that lie
    close together, or outside [0, 1], spread like others. NULL if one class is absent.
    """
    counted = scored.filter(F.col(label).isNotNull() & F.col(score_column).isNotNull()).groupBy(
        F.col(score_column).cast("double").alias("_score")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) != 1).alias("_neg"))
    cuts = counted.approxQuantile("_score", [i / buckets for i in range(1, buckets)], 0.25 / buckets)
    inner = sorted({c + 0.0 for c in cuts if math.isfinite(c)})
    if inner:
        counted = Bucketizer(splits=[-math.inf, *inner, math.inf], inputCol="_score", outputCol="_bucket",
                             handleInvalid="keep").transform(counted)
    else:
        counted = counted.withColumn("_bucket", F.lit(0.0))
    totals = counted.groupBy("_bucket").agg(F.sum("_neg").alias("_bucket_neg"))
    below = totals.select("_bucket", F.coalesce(F.sum("_bucket_neg").over(
        Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_below"))
    inside = Window.partitionBy("_bucket").orderBy("_score").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counted.withColumn("_inside", F.coalesce(F.sum("_neg").over(inside), F.lit(0)))
    # A positive beats every negative with a lower score and half of those with the same one.
    beaten = F.col("_below") + F.col("_inside") + F.col("_neg") / 2
    summed = ranked.join(below, "_bucket").agg(
        F.sum(F.col("_pos") * beaten).alias("_wins"),
        F.coalesce(F.sum("_pos"), F.lit(0)).alias("positives"),
        F.coalesce(F.sum("_neg"), F.lit(0)).alias("negatives"))
    pairs = F.col("positives").cast("double") * F.col("negatives")
    return summed.select(F.try_divide("_wins", pairs).alias("auc"), "positives", "negatives")


def importances(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``feature``, ``source_column``, ``importance``: the forest's weights under their real names.

    Names come from the assembled vector's metadata, which follows the one-hot expansion slot by slot. Sum by
    ``source_column`` for the weight of a whole input column.
    """
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    transformed = model.transform(prepared(df, [c for c in assembler.getInputCols() if not c.endswith("_vec")]))
    attributes = transformed.schema[assembler.getOutputCol()].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in attributes.values() for a in group}
    inputs = sorted(assembler.getInputCols(), key=len, reverse=True)
    weights = model.stages[-1].featureImportances.toArray()

    def source(name: str) -> str:
        column = next(c for c in inputs if name == c or name.startswith(f"{c}_"))
        return column.removesuffix("_vec")

    rows = [(names[i], source(names[i]), float(w)) for i, w in enumerate(weights)]
    return df.sparkSession.createDataFrame(rows, "feature STRING, source_column STRING, importance DOUBLE")


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def log_run(spark: SparkSession, trained: Trained, run_name: str, source_table: str, logged_at=None,
            table: str | None = None) -> DataFrame:
    """One row with the run's parameters and results, also appended to ``table`` if given."""
    forest = trained.model.stages[-1]
    row = spark.range(1).select(
        F.lit(run_name).alias("run_name"),
        F.lit(source_table).alias("table_name"),
        F.lit(forest.getNumTrees).cast("int").alias("num_trees"),
        F.lit(trained.train_rows).cast("long").alias("train_rows"),
        F.lit(trained.test_rows).cast("long").alias("test_rows"),
        F.lit(trained.feature_count).cast("int").alias("feature_columns"),
        F.lit(trained.auc).cast("double").alias("auc"),
        (F.current_timestamp() if logged_at is None else F.lit(logged_at)).alias("logged_at"))
    if table:
        tables.append(spark, row, table)
    return row
