"""Cleaning and de-duplication of raw event rows, and the event ledger's merge rules."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from churnflow.functions import date_literal, normalized_text, parse_day_month_year, timestamp_literal
from churnflow.operators.merge import survivors
from churnflow.operators.quality import STAGED_REQUIRED
from churnflow.schemas import EVENT_KEY, PRICE, UNITS

RECHECK_DAYS = 5


def _typed(raw: DataFrame) -> DataFrame:
    return raw.dropna(subset=list(STAGED_REQUIRED)).select(
        normalized_text(F.col("site_id")).alias("site_id"),
        "user_id",
        parse_day_month_year(F.col("purchase_date")).alias("purchase_date"),
        normalized_text(F.col("crypto_type")).alias("crypto_type"),
        F.col("purchase_price").cast(PRICE).alias("purchase_price"),
        F.col("purchase_units").cast(UNITS).alias("purchase_units"),
    )


def _with_value(events: DataFrame) -> DataFrame:
    value = (F.col("purchase_price") * F.col("purchase_units")).cast(UNITS)
    return events.withColumn("purchase_value", value)


def clean_events(raw: DataFrame) -> DataFrame:
    """Typed event rows; a row missing any required field is dropped."""
    return _with_value(_typed(raw))


def keep_top_row(df: DataFrame, key: Sequence[str], highest: Sequence[str]) -> DataFrame:
    """One row per key: the one with the highest ``highest`` columns, compared in order.

    The remaining columns break ties, so the choice is deterministic. A maximum of structs is
    reduced on the map side: of a key that holds a large share of all rows, each task passes on
    a single row.
    """
    rest = [c for c in df.columns if c not in key and c not in highest]
    top = df.groupBy(*key).agg(F.max(F.struct(*highest, *rest)).alias("top"))
    return top.select(*(F.col(c) if c in key else F.col(f"top.{c}").alias(c) for c in df.columns))


# A price and units as one whole number that orders as the pair does: both fill 18 digits, so units never reach this step.
_ONE = 10**18
_STEP = Decimal(2 * _ONE)


def _packed(price: Column, units: Column) -> Column:
    whole = (c.cast(k) * F.lit(10**k.scale) for c, k in ((price, PRICE), (units, UNITS)))
    price, units = (w.cast("decimal(18,0)") for w in whole)
    return (price * F.lit(_STEP) + units).cast("decimal(38,0)")


def _unpacked(pair: Column) -> tuple[Column, Column]:
    """Price and units again. Whole-number division needs a number that is not negative."""
    shifted = F.call_function("div", pair + F.lit(Decimal(_ONE + 2 * _ONE * _ONE)), F.lit(_STEP))
    price = (shifted - F.lit(_ONE)).cast("decimal(18,0)")
    units = (pair - price * F.lit(_STEP)).cast("decimal(18,0)")
    tiny = (F.lit(Decimal(1).scaleb(-k.scale)) for k in (PRICE, UNITS))
    return tuple((w * t).cast(k) for w, t, k in zip((price, units), tiny, (PRICE, UNITS)))


def dedupe_latest(events: DataFrame) -> DataFrame:
    """One row per event key: the highest price, then the most units.

    The pair is packed into one number, whose maximum Spark takes in a hash table; that of a struct would sort all rows
    before and after the shuffle.
    Cleaned events have both.
    """
    if set(events.columns) - {*EVENT_KEY, "purchase_price", "purchase_units", "purchase_value"}:
        return keep_top_row(events, EVENT_KEY, ["purchase_price", "purchase_units"])
    top = events.groupBy(*EVENT_KEY).agg(F.max(_packed(F.col("purchase_price"), F.col("purchase_units"))).alias("pair"))
    price, units = _unpacked(F.col("pair"))
    found = top.select(*EVENT_KEY, price.alias("purchase_price"), units.alias("purchase_units"))
    return _with_value(found).select(*events.columns)


def stage_events(raw: DataFrame) -> DataFrame:
    """Clean rows, one per event key. Values are computed last, so they are not shuffled."""
    return _with_value(dedupe_latest(_typed(raw)))


def recheck_start(ds: date) -> date:
    return ds - timedelta(days=RECHECK_DAYS)


def _due_for_recheck(ds: date) -> Column:
    return F.col("purchase_date") >= date_literal(recheck_start(ds))


def as_ledger_rows(staged: DataFrame, run_ts: datetime) -> DataFrame:
    """Staged rows as the ledger stores them: active as of this run."""
    return staged.select(
        *EVENT_KEY, "purchase_price", "purchase_units", "purchase_value",
        F.lit(True).alias("is_active"),
        timestamp_literal(run_ts).alias("updated_at"),
    )


def missing_from_source(ledger: DataFrame, staged: DataFrame, ds: date) -> DataFrame:
    """Ledger rows dated from five days before ``ds`` on whose key is not staged."""
    due = _due_for_recheck(ds)
    return ledger.filter(due).join(staged.filter(due).select(*EVENT_KEY), list(EVENT_KEY), "left_anti")


def deactivate_missing(ledger: DataFrame, staged: DataFrame, ds: date, run_ts: datetime) -> DataFrame:
    """The whole ledger with recent rows switched off if their key is not staged.

    Older rows pass through without a shuffle; only the recent part meets the staged keys.
    """
    due = _due_for_recheck(ds)
    staged_keys = staged.filter(due).select(*EVENT_KEY).distinct().withColumn("staged", F.lit(True))
    recent = ledger.filter(due).join(staged_keys, list(EVENT_KEY), "left")
    gone = F.col("staged").isNull()
    checked = recent.withColumns({
        "is_active": F.col("is_active") & ~gone,
        "updated_at": F.when(gone, timestamp_literal(run_ts)).otherwise(F.col("updated_at")),
    }).drop("staged")
    return ledger.filter(~due | F.col("purchase_date").isNull()).unionByName(checked)


def unmatched_after_run(ledger: DataFrame, staged: DataFrame, ds: date, run_ts: datetime) -> DataFrame:
    """Ledger rows the upsert leaves alone, with the recent ones among them switched off.

    A row survives the upsert exactly if its key is not staged, so the soft delete needs no join
    of its own: among survivors, being recent is enough.
    """
    due = F.coalesce(_due_for_recheck(ds), F.lit(False))
    return survivors(ledger, staged, EVENT_KEY).withColumns({
        "is_active": F.col("is_active") & ~due,
        "updated_at": F.when(due, timestamp_literal(run_ts)).otherwise(F.col("updated_at")),
    })


def merge_events(ledger: DataFrame, staged: DataFrame, ds: date, run_ts: datetime) -> DataFrame:
    """The ledger after upserting ``staged`` and then switching off what it lacks."""
    active = as_ledger_rows(staged, run_ts)
    return active.unionByName(unmatched_after_run(ledger, staged, ds, run_ts).select(*active.columns))
