"""Daily event load: clean, check, upsert into the ledger, switch off what vanished."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, functions as F

from churnflow.functions import as_date, date_literal
from churnflow.operators.events import as_ledger_rows, recheck_start, stage_events, unmatched_after_run
from churnflow.operators.quality import require, staged_event_checks
from churnflow.schemas import LEDGER, RAW_EVENTS, STAGED_EVENTS
from churnflow.sources import Lake


def update_ledger(lake: Lake, ds: date | str, as_of: date | None = None, run_ts: datetime | None = None, raw: DataFrame | None = None, *, keep_unchanged: bool = False) -> None:
    """Clean, check, upsert and switch off, against the stored staging and ledger tables.

    Only months that occur in the staged rows, or lie within the re-check range, are read and rewritten. Raises, before
    anything is merged, if a check fails. Running it twice gives the same ledger as running it once.

    Every staged row gets the run's update time. With ``keep_unchanged``, months in which nothing else differs
    stay as they are, update times included: a daily full reload then writes the few months that changed, and a second
    run of the day none.
    """
    lake.recover(LEDGER)
    ds, run_ts = as_date(ds), run_ts or datetime.now(timezone.utc)
    raw = lake.read(RAW_EVENTS) if raw is None else raw
    lake.replace(stage_events(raw), STAGED_EVENTS, load_ts=run_ts)
    staged = lake.read(STAGED_EVENTS)
    require(staged, staged_event_checks(as_of or run_ts.date()))

    month = F.trunc("purchase_date", "MM")
    months = [r.m for r in staged.select(month.alias("m")).distinct().collect()]  # calendar months
    first_due_month = recheck_start(ds).replace(day=1)
    touched = lake.read_or_empty(LEDGER).filter(
        F.col("purchase_month").isin(months) | (F.col("purchase_month") >= date_literal(first_due_month)))
    content = [c for c in LEDGER.columns if c != "updated_at"]
    lake.publish(
        unmatched_after_run(touched, staged, ds, run_ts), as_ledger_rows(staged, run_ts), LEDGER, unless_same=content if keep_unchanged else ())
