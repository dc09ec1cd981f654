"""Weekly feature build, for one snapshot date or many at once, from all payments or from kept totals."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Row, functions as F

from churnflow.functions import as_date, date_literal
from churnflow.operators.features import PaymentHistory, between_days, build_features, daily_totals, history_from_state
from churnflow.operators.quality import require_snapshots
from churnflow.schemas import FEATURES, PAYMENT_DAYS, PAYMENT_LOG, PAYMENT_MONTHS, RAW_CUSTOMER_TABLES, RAW_PAYMENTS
from churnflow.sources import Lake, staged


def update_features(
    lake: Lake, snapshots: Sequence[date | str], run_ts: datetime | None = None, raw: Mapping[str, DataFrame] | None = None, *, incremental: bool = False
) -> None:
    """Build the snapshots, check them, and upsert them into the feature table.

    Only the partitions of these dates are read and rewritten. An ``incremental`` build first takes the days that
    are new into the kept payment totals, and reads no older payments.
    """
    snapshots = [as_date(s) for s in snapshots]
    run_ts = run_ts or datetime.now(timezone.utc)
    history = _kept_history(lake, max(snapshots), run_ts) if incremental else None
    needed = (name for name in RAW_CUSTOMER_TABLES if not (incremental and name == "payments"))
    placed = raw is None and len({lake.buckets_of(RAW_CUSTOMER_TABLES[name]) for name in RAW_CUSTOMER_TABLES} - {None}) == 1 and all(
        map(lake.buckets_of, RAW_CUSTOMER_TABLES.values()))
    raw = raw or {name: lake.read(RAW_CUSTOMER_TABLES[name]) for name in needed}
    rows = build_features(raw, snapshots, run_ts, history, placed=placed)
    with staged(rows, FEATURES.name) as built:
        require_snapshots(built, snapshots)
        # One row per customer and date by construction.
        lake.upsert(built, FEATURES, F.col("snapshot_date").isin(snapshots), keys_unique=True)


def _kept_history(lake: Lake, until: date, run_ts: datetime) -> Callable[[Sequence[date]], PaymentHistory]:
    covered = payments_covered_until(lake)
    if covered is None or covered < until:
        update_payment_totals(lake, until, run_ts=run_ts)
    return lambda dates: history_from_state(lake.read(PAYMENT_DAYS), lake.read(PAYMENT_MONTHS), dates)


def payments_covered_until(lake: Lake) -> date | None:
    """The first day that the kept totals do not cover yet."""
    return lake.read_or_empty(PAYMENT_LOG).agg(F.max("covered_until")).first()[0]


def update_payment_totals(lake: Lake, until: date | str, since: date | str | None = None, run_ts: datetime | None = None) -> None:
    """Take the payments from ``since`` on and before ``until`` into the kept totals.

    ``since`` is where the last run ended, by default; an earlier day corrects what changed since. Days are replaced,
    never added to, so a run can be repeated. Payments without a date are taken anew each time. Of the stored totals only the
    months in question are read and rewritten, and of the payments only their folders.
    """
    until, run_ts = as_date(until), run_ts or datetime.now(timezone.utc)
    since = as_date(since) if since is not None else payments_covered_until(lake)
    due = between_days(since, until, True) | F.col("pay_month").isNull()
    for table in (PAYMENT_DAYS, PAYMENT_MONTHS):
        lake.recover(table)
    months = F.col("pay_month") <= F.trunc(F.date_sub(date_literal(until), 1), "MM")
    if since is not None:
        months = months & (F.col("pay_month") >= date_literal(since.replace(day=1)))
    touched = months | F.col("pay_month").isNull()
    with staged(daily_totals(lake.read(RAW_PAYMENTS).filter(due)), PAYMENT_DAYS.name) as new:
        kept = lake.read_or_empty(PAYMENT_DAYS).filter(touched).filter(~F.coalesce(due, F.lit(False)))
        lake.publish(kept, new, PAYMENT_DAYS, touched=touched)
    last = lake.read(PAYMENT_DAYS).filter(touched).groupBy("customer_id", "pay_month").agg(F.max("fecha").alias("last_day"))
    lake.publish(lake.read_or_empty(PAYMENT_MONTHS).filter("false"), last, PAYMENT_MONTHS, touched=touched)
    log = lake.spark.createDataFrame([Row(covered_until=max(until, payments_covered_until(lake) or until), run_ts=run_ts, read_from=since)], PAYMENT_LOG.schema)
    lake.append(log, PAYMENT_LOG)
