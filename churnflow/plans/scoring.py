"""Weekly batch scoring of one snapshot."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from churnflow.functions import as_date
from churnflow.operators.registry import current_model
from churnflow.operators.scoring import DECISION_THRESHOLD, scenario_grid, score
from churnflow.plans.training import MODEL_NAME
from churnflow.schemas import FEATURES, MODEL_LOG, SCORES
from churnflow.sources import Lake, read_snapshot


def load_production_model(lake: Lake, model_name: str = MODEL_NAME) -> tuple[PipelineModel, int]:
    live = current_model(lake.read_or_empty(MODEL_LOG)).filter(F.col("model_name") == model_name).first()
    if live is None:
        raise RuntimeError(f"{model_name} has no promoted version to score with")
    return PipelineModel.load(live.path), live.version


def score_snapshot(lake: Lake, snapshot: date | str, threshold: float = DECISION_THRESHOLD, model_name: str = MODEL_NAME, run_ts: datetime | None = None) -> int:
    """Score one snapshot with the production model, replacing that model's scores for the date."""
    snapshot = as_date(snapshot)
    features = read_snapshot(lake.read_or_empty(FEATURES), snapshot)
    if features.isEmpty():
        raise ValueError(f"the feature table holds nothing for {snapshot}")
    model, version = load_production_model(lake, model_name)
    scored = score(features, model, str(version), run_ts or datetime.now(timezone.utc), threshold)
    lake.replace_partitions(scored, SCORES, rebalance=False)
    return version


def score_scenarios(lake: Lake, snapshot: date | str, scenarios: Mapping[str, Mapping[str, object]], threshold: float = DECISION_THRESHOLD, model_name: str = MODEL_NAME, run_ts: datetime | None = None) -> DataFrame:
    """What the production model says of a snapshot under each named scenario. Nothing is stored."""
    model, version = load_production_model(lake, model_name)
    grid = scenario_grid(read_snapshot(lake.read(FEATURES), as_date(snapshot)), scenarios)
    return score(grid, model, str(version), run_ts or datetime.now(timezone.utc), threshold)
