"""Choice of the model's settings by cross-validation on the training window."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from churnflow.functions import as_date
from churnflow.operators.modeling import training_set
from churnflow.operators.tuning import Setting, fold_metrics, held_out_scores, setting_metrics, with_fold
from churnflow.schemas import FEATURES, TUNING_RUNS
from churnflow.sources import Lake, staged

# Penalties of the logistic regression; the first is the model as it is trained without tuning.
SETTINGS: dict[str, Setting] = {
    "plain": {}, "ridge-0.001": {"regParam": 0.001}, "ridge-0.01": {"regParam": 0.01}, "ridge-0.1": {"regParam": 0.1},
    "lasso-0.001": {"regParam": 0.001, "elasticNetParam": 1.0}, "lasso-0.01": {"regParam": 0.01, "elasticNetParam": 1.0},
}


def tune(
    lake: Lake, snapshot: date | str, settings: Mapping[str, Setting] = SETTINGS, folds: int = 5, lookback_weeks: int = 8, run_ts: datetime | None = None
) -> str:
    """Measure every setting on every fold of the trailing window, keep the figures, and return the best setting's name."""
    rows = with_fold(training_set(lake.read(FEATURES), as_date(snapshot), lookback_weeks, keys_unique=True), folds)
    with staged(rows, "tuning-rows") as stored:
        with staged(held_out_scores(stored, settings), "held-out-scores") as predictions:
            by_fold = fold_metrics(predictions)
    best = setting_metrics(by_fold).first()
    lake.append(by_fold.withColumn("snapshot_date", F.lit(as_date(snapshot))), TUNING_RUNS, run_ts=run_ts or datetime.now(timezone.utc))
    return best.setting
