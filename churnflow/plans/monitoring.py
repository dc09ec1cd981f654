"""Weekly watch over the feature table: profiles, limits taken from earlier ones, drift."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from churnflow.functions import as_date, date_literal
from churnflow.operators.monitoring import bin_counts, decile_edges, drift, limit_checks, profile, profile_limits
from churnflow.operators.quality import Check, DataQualityError, count_broken
from churnflow.schemas import FEATURE_PROFILES, FEATURES
from churnflow.sources import Lake, read_snapshot


def profile_snapshots(lake: Lake, snapshots: Sequence[date | str]) -> None:
    """Profile the snapshots in one pass and keep the profiles in place of earlier ones of these dates."""
    days = [as_date(s) for s in snapshots]
    lake.replace_partitions(profile(lake.read(FEATURES).filter(F.col("snapshot_date").isin(days))), FEATURE_PROFILES)


def checks_from_history(lake: Lake, snapshot: date | str, widen: float = 3.0) -> list[Check]:
    """Checks of a snapshot by the profiles kept of earlier dates; their rows are not read again."""
    earlier = lake.read_or_empty(FEATURE_PROFILES).filter(F.col("snapshot_date") < date_literal(as_date(snapshot)))
    return limit_checks(profile_limits(earlier, widen).collect(), lake.read(FEATURES))  # a row per feature


def check_snapshot(lake: Lake, snapshot: date | str, widen: float = 3.0, allowed: float = 0.01) -> None:
    """Raise if in some feature more than the ``allowed`` share of a snapshot's numbers leaves the limits."""
    rows = read_snapshot(lake.read(FEATURES), as_date(snapshot))
    checks = checks_from_history(lake, snapshot, widen)
    if not checks:
        return
    total = rows.count()
    broken = {r.check_name: r.offending_rows for r in count_broken(rows, checks).collect()}  # a row per check
    failed = [f"{name}: {n} of {total} rows" for name, n in broken.items() if n > allowed * total]
    if failed:
        raise DataQualityError("; ".join(failed))


def snapshot_drift(lake: Lake, baseline: date | str, edges: Mapping[str, Sequence[float]] | None = None) -> DataFrame:
    """The drift of all other snapshots against ``baseline``, in bins of its deciles unless others are given."""
    rows, baseline = lake.read(FEATURES), as_date(baseline)
    edges = decile_edges(read_snapshot(rows, baseline)) if edges is None else edges
    return drift(bin_counts(rows, edges), baseline)
