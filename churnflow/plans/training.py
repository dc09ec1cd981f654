"""Monthly training: fit, evaluate, store, promote."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from churnflow.functions import as_date
from churnflow.operators.evaluation import accuracy, counts_by_score, roc_auc
from churnflow.operators.modeling import (
    assembler_inputs,
    churn_estimator,
    present,
    split_summary,
    training_set,
    with_split,
)
from churnflow.operators.registry import PROMOTED, REGISTERED, next_version
from churnflow.operators.tuning import Setting
from churnflow.schemas import CATEGORICAL_FEATURES, FEATURES, LABEL, MODEL_LOG, TRAINING_RUNS
from churnflow.sources import Lake, staged

MODEL_NAME = "churn-logreg"


def fit_and_evaluate(rows: DataFrame, setting: Setting | None = None) -> tuple[PipelineModel, dict[str, float]]:
    """Fit on the train split only, and measure on the test split. Only counts reach the driver."""
    split = rows if "split" in rows.columns else with_split(rows)
    summary = {r.split: r for r in split_summary(split).collect()}
    for name in ("train", "test"):
        if name not in summary:
            raise ValueError(f"the {name} split is empty")
    train = split.filter(F.col("split") == "train")
    model = churn_estimator(train, **(setting or {})).fit(train)

    predicted = model.transform(split.filter(F.col("split") == "test")).select(
        vector_to_array("probability")[1].alias("score"), "prediction", LABEL)
    with staged(counts_by_score(predicted), "counts-by-score") as by_score:
        metrics = {"roc_auc": roc_auc(by_score).first().roc_auc, "accuracy": accuracy(by_score).first().accuracy}
    for name in ("train", "test"):
        metrics[f"positive_rate_{name}"] = summary[name].positive_rate
        metrics[f"{name}_rows"] = summary[name].n_rows
    return model, metrics


def train_and_register(lake: Lake, snapshot: date | str, lookback_weeks: int = 8, model_name: str = MODEL_NAME, run_ts: datetime | None = None, setting: Setting | None = None) -> int:
    """Train on the trailing window, store the model under the next version, and promote it.

    ``setting`` is one that ``tune`` has chosen. Of two runs at once the one that comes second to store its model fails, and
    can be repeated: it then takes the next version.
    """
    spark, run_ts, snapshot = lake.spark, run_ts or datetime.now(timezone.utc), as_date(snapshot)
    rows = with_split(training_set(lake.read(FEATURES), snapshot, lookback_weeks, keys_unique=True))
    # Fitting and measuring read the rows several times.
    with staged(rows, "training-rows") as rows:
        model, metrics = fit_and_evaluate(rows, setting)

    version = next_version(lake.read_or_empty(MODEL_LOG), model_name)
    path = f"{lake.root}/models/{model_name}/v={version}"
    model.write().save(path)  # fails where another run has taken the version
    PipelineModel.load(path)  # only what can be read back is promoted

    params = {
        "snapshot_date": snapshot.isoformat(),
        "lookback_weeks": str(lookback_weeks),
        "numeric_features": ",".join(assembler_inputs(rows)),
        "categorical_features": ",".join(present(CATEGORICAL_FEATURES, rows)),
        **{name: str(value) for name, value in (setting or {}).items()},
    }
    tags = {"model_version": str(version), "production_ready": "True"}
    run = {
        **metrics, "model_name": model_name, "model_version": version, "created_at": run_ts,
        "params": params, "tags": tags,
    }
    lake.append(spark.createDataFrame([tuple(run[c] for c in TRAINING_RUNS.columns)], TRAINING_RUNS.schema), TRAINING_RUNS)
    events = [(model_name, version, path, event, run_ts) for event in (REGISTERED, PROMOTED)]
    lake.append(spark.createDataFrame(events, MODEL_LOG.schema), MODEL_LOG)
    return version
