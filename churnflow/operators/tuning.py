"""Cross-validation by customer: folds, exact metrics of every fold and setting in one job, and the choice among settings."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from churnflow.functions import split_bucket
from churnflow.operators.evaluation import accuracy, counts_by_score, roc_auc
from churnflow.operators.modeling import churn_estimator
from churnflow.schemas import FEATURE_KEY, LABEL
from churnflow.sources.scratch import staged

Setting = Mapping[str, object]


def fold_of(folds: int) -> Column:
    """A fold from the customer's id alone, so all snapshots of a customer are on the same side."""
    return (split_bucket(F.lit("fold"), F.col("customer_id"), buckets=folds)).cast("int")


def with_fold(rows: DataFrame, folds: int) -> DataFrame:
    if folds < 2:
        raise ValueError("cross-validation needs two folds at least")
    return rows.withColumn("fold", fold_of(folds))


def held_out_scores(rows: DataFrame, settings: Mapping[str, Setting]) -> DataFrame:
    """(setting, fold, score, prediction, label): every row scored by the models that have not seen its customer.

    One model is fitted per setting and fold, on the driver's word but in the tasks; predictions stay plans until the metrics are taken.
    """
    folds = [r.fold for r in rows.select("fold").distinct().orderBy("fold").collect()]  # a row per fold
    scored = []
    for name, setting in settings.items():
        for fold in folds:
            train = rows.filter(F.col("fold") != fold)
            model = churn_estimator(train, **setting).fit(train)
            out = model.transform(rows.filter(F.col("fold") == fold))
            scored.append(out.select(
                F.lit(name).alias("setting"), "fold", *FEATURE_KEY, vector_to_array("probability")[1].alias("score"), "prediction", LABEL))
    return reduce(DataFrame.unionByName, scored)


def fold_metrics(predictions: DataFrame) -> DataFrame:
    """(setting, fold, n_rows, positives, roc_auc, accuracy), all in one job over ``predictions``."""
    groups = ("setting", "fold")
    with staged(counts_by_score(predictions, groups=groups), "counts-by-fold") as by_score:
        sizes = by_score.groupBy(*groups).agg(
            F.sum(F.col("positives") + F.col("negatives")).alias("n_rows"), F.sum("positives").alias("positives"))
        found = sizes.join(roc_auc(by_score, *groups), list(groups)).join(accuracy(by_score, *groups), list(groups))
        rows = found.collect()  # a row per setting and fold
    return predictions.sparkSession.createDataFrame(rows, found.schema)


def setting_metrics(by_fold: DataFrame) -> DataFrame:
    """(setting, folds, roc_auc, roc_auc_stddev, accuracy): means over folds, best first by area, then by name."""
    return by_fold.groupBy("setting").agg(
        F.count("roc_auc").alias("folds"), F.avg("roc_auc").alias("roc_auc"), F.stddev_samp("roc_auc").alias("roc_auc_stddev"),
        F.avg("accuracy").alias("accuracy"),
    ).orderBy(F.desc_nulls_last("roc_auc"), "setting")
