"""Exact classification metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from churnflow.schemas import LABEL


def counts_by_score(
    predictions: DataFrame, score: str = "score", prediction: str = "prediction", label: str = LABEL, groups: Sequence[str] = ()
) -> DataFrame:
    """Per distinct score (of each group): positive, negative and correctly predicted rows. All metrics follow from it."""
    return predictions.groupBy(*groups, F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) > 0.5).alias("positives"),
        F.count_if(F.col(label) <= 0.5).alias("negatives"),
        F.count_if(F.col(prediction) == F.col(label)).alias("correct"),
    )


def accuracy(by_score: DataFrame, *groups: str) -> DataFrame:
    rows = F.sum(F.col("positives") + F.col("negatives"))
    return by_score.groupBy(*groups).agg((F.sum("correct") / rows).alias("accuracy"))


def roc_auc(by_score: DataFrame, *groups: str) -> DataFrame:
    """One row (per group): the exact area under the ROC curve, as a rank sum in which ties count half.

    The number of negatives below each score is a running total over all distinct scores. It is
    taken in two steps so that no task sees them all: within score ranges of about equal size, cut
    at quantiles of the data, and over the totals of those ranges, as many as shuffle partitions. ``by_score`` is
    read twice, first for the cuts, so it should be a stored table.
    """
    ranges = max(2, int(by_score.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    quantiles = [i / ranges for i in range(1, ranges)]
    cuts = by_score.agg(F.percentile_approx("score", quantiles, 10_000).alias("cuts")).first().cuts or [0.5]
    ends = [float("-inf"), *sorted(set(cuts)), float("inf")]
    ranged = Bucketizer(splits=ends, inputCol="score", outputCol="score_range").transform(by_score)

    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    within = before.partitionBy(*groups, "score_range").orderBy("score")
    ranked = ranged.withColumn("below", F.coalesce(F.sum("negatives").over(within), F.lit(0)))

    # Twice the rank sum is a whole number, so it adds up exactly in any order.
    twice_won = _product(F.col("positives"), 2 * F.col("below") + F.col("negatives"))
    per_range = ranked.groupBy(*groups, "score_range").agg(
        F.sum(twice_won).alias("twice_won"), F.sum("positives").alias("positives"), F.sum("negatives").alias("negatives"))
    below_range = F.coalesce(F.sum("negatives").over((before.partitionBy(*groups) if groups else before).orderBy("score_range")), F.lit(0))
    total = per_range.withColumn("below", below_range)
    won = F.sum(F.col("twice_won") + _product(F.col("positives"), 2 * F.col("below"))).cast("double")
    pairs = F.sum("positives").cast("double") * F.sum("negatives").cast("double")
    return total.groupBy(*groups).agg(F.try_divide(won, 2 * pairs).alias("roc_auc"))


def _product(a: Column, b: Column) -> Column:
    return a.cast("decimal(18,0)") * b.cast("decimal(19,0)")
