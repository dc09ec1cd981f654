"""Training data, the deterministic split, and the classification model."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, functions as F

from churnflow.functions import split_bucket
from churnflow.schemas import BINARY_FEATURES, CATEGORICAL_FEATURES, FEATURE_KEY, LABEL, NUMERIC_FEATURES, UNKNOWN
from churnflow.sources.reads import read_window

MAX_ITERATIONS = 50
TRAIN_PERCENT = 80


def present(columns: Sequence[str], df: DataFrame) -> list[str]:
    return [c for c in columns if c in df.columns]


def training_set(features: DataFrame, end: date, lookback_weeks: int = 8, *, keys_unique: bool = False) -> DataFrame:
    """Labelled rows of the trailing window with model-ready types.

    Feature columns that do not exist are left out. Missing categories become ``unknown``; missing
    numbers stay missing. ``keys_unique`` skips the de-duplication, and its shuffle, for input
    known to hold each (customer, snapshot) once, such as the stored feature table.
    """
    rows = read_window(features, end, lookback_weeks)
    if not keys_unique:
        rows = rows.dropDuplicates(list(FEATURE_KEY))
    numbers = present([*NUMERIC_FEATURES, *BINARY_FEATURES, LABEL], rows)
    categories = present(CATEGORICAL_FEATURES, rows)
    return (
        rows.dropna(subset=[LABEL])
        .select(*FEATURE_KEY, *(F.col(c).cast("double").alias(c) for c in numbers), *categories)
        .fillna(UNKNOWN, subset=categories)
    )


def with_split(rows: DataFrame, train_percent: int = TRAIN_PERCENT) -> DataFrame:
    """Adds ``split``: train or test, decided by the row's key and by nothing else."""
    bucket = split_bucket(*(F.col(c) for c in FEATURE_KEY))
    return rows.withColumn("split", F.when(bucket < train_percent, "train").otherwise("test"))


def split_summary(rows: DataFrame) -> DataFrame:
    """Size and positive rate of each split, in one pass."""
    return rows.groupBy("split").agg(F.count("*").alias("n_rows"), F.avg(LABEL).alias("positive_rate"))


def category_stages(categories: Sequence[str]) -> list:
    """Frequency-ordered index, then one-hot; unseen and missing values get a slot of their own."""
    if not categories:
        return []
    indexed = [f"{c}_idx" for c in categories]
    return [
        StringIndexer(inputCols=list(categories), outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=[f"{c}_oh" for c in categories], handleInvalid="keep"),
    ]


def assembler_inputs(rows: DataFrame) -> list[str]:
    one_hots = [f"{c}_oh" for c in present(CATEGORICAL_FEATURES, rows)]
    return [*present(NUMERIC_FEATURES, rows), *present(BINARY_FEATURES, rows), *one_hots]


def churn_estimator(rows: DataFrame, **options: object) -> Pipeline:
    """Unfitted model for the feature columns that ``rows`` has; ``options`` are those of the regression."""
    options = {"maxIter": MAX_ITERATIONS, "elasticNetParam": 0.0, **options}
    return Pipeline(stages=[
        *category_stages(present(CATEGORICAL_FEATURES, rows)),
        VectorAssembler(inputCols=assembler_inputs(rows), outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol=LABEL, **options),
    ])


def category_index(rows: DataFrame, categories: Sequence[str] = tuple(CATEGORICAL_FEATURES)) -> DataFrame:
    """(feature, label, n_rows, idx) for all features, as a fitted index numbers them: most frequent label
    first, ties by label. The labels are those a fitted model holds anyway."""
    filled = rows.select(*(F.coalesce(F.col(c), F.lit(UNKNOWN)).alias(c) for c in categories))
    fitted = category_stages(categories)[0].fit(filled)
    numbered = [
        (feature, label, i) for feature, labels in zip(categories, fitted.labelsArray, strict=True) for i, label in enumerate(labels)]
    pairs = filled.select(F.inline(F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).alias("label")) for c in categories))))
    counted = pairs.groupBy("feature", "label").agg(F.count("*").alias("n_rows"))
    index = rows.sparkSession.createDataFrame(numbered, "feature string, label string, idx int")
    return counted.join(index, ["feature", "label"]).select("feature", "label", "n_rows", "idx")
