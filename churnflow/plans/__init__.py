from churnflow.plans.event_etl import update_ledger
from churnflow.plans.feature_build import payments_covered_until, update_features, update_payment_totals
from churnflow.plans.loading import load_raw_tables
from churnflow.plans.monitoring import check_snapshot, profile_snapshots, snapshot_drift
from churnflow.plans.scoring import load_production_model, score_scenarios, score_snapshot
from churnflow.plans.training import train_and_register
from churnflow.plans.tuning import tune

__all__ = [
    "check_snapshot",
    "load_production_model",
    "load_raw_tables",
    "payments_covered_until",
    "profile_snapshots",
    "score_scenarios",
    "score_snapshot",
    "snapshot_drift",
    "train_and_register",
    "tune",
    "update_features",
    "update_ledger",
    "update_payment_totals",
]
