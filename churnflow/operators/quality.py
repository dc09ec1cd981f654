"""Data-quality checks. All checks on a table are counted in one pass over it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from churnflow.functions import date_literal
from churnflow.schemas import Table

STAGED_REQUIRED = ("site_id", "user_id", "purchase_date", "crypto_type", "purchase_price", "purchase_units")
VALUE_TOLERANCE = Decimal("0.0001")


class DataQualityError(ValueError):
    """A check failed; the message names it and the number of offending rows."""


@dataclass(frozen=True)
class Check:
    """``broken`` holds for an offending row; NULL counts as not broken."""

    name: str
    broken: Column


def count_broken(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row (check_name, offending_rows) per check, from a single aggregation."""
    counts = df.agg(*(F.count_if(c.broken).alias(f"c{i}") for i, c in enumerate(checks)))
    return counts.select(F.inline(F.array(*(
        F.struct(F.lit(c.name).alias("check_name"), F.col(f"c{i}").alias("offending_rows"))
        for i, c in enumerate(checks)
    ))))


def require(df: DataFrame, checks: Sequence[Check]) -> None:
    """Raise ``DataQualityError`` if any check counts an offending row."""
    failed = [
        f"{row.check_name}: {row.offending_rows} rows break this rule"
        for row in count_broken(df, checks).collect()  # one row per check
        if row.offending_rows
    ]
    if failed:
        raise DataQualityError("; ".join(failed))


def staged_event_checks(as_of: date) -> list[Check]:
    """Missing required fields, dates after tomorrow, and values that are not price times units."""
    product = F.col("purchase_price") * F.col("purchase_units")
    return [
        Check("required_value_missing", reduce(lambda a, b: a | b, (F.col(c).isNull() for c in STAGED_REQUIRED))),
        Check("dated_after_tomorrow", F.col("purchase_date") > F.date_add(date_literal(as_of), 1)),
        Check("value_is_not_price_times_units", F.abs(F.col("purchase_value") - product) > F.lit(VALUE_TOLERANCE)),
    ]


def not_null_checks(table: Table) -> list[Check]:
    return [Check(f"{table.name}.{c}", F.col(c).isNull()) for c in table.required]


def snapshot_summary(features: DataFrame) -> DataFrame:
    """Rows and rows without a customer, per snapshot date."""
    return features.groupBy("snapshot_date").agg(
        F.count("*").alias("feature_rows"),
        F.count_if(F.col("customer_id").isNull()).alias("null_customers"),
    )


def require_snapshots(features: DataFrame, snapshots: Sequence[date]) -> None:
    """Every snapshot date must have rows, and every row a customer."""
    found = {row.snapshot_date: row for row in snapshot_summary(features).collect()}  # one row per snapshot
    for snapshot in snapshots:
        row = found.get(snapshot)
        if row is None:
            raise DataQualityError(f"nothing was built for {snapshot}")
        if row.null_customers:
            raise DataQualityError(f"{snapshot}: {row.null_customers} rows lack a customer")


def key_repeats(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: how many keys occur more than once, and how many rows are beyond the first of a key."""
    per_key = df.groupBy(*key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"),
    )


def require_unique_key(df: DataFrame, key: Sequence[str]) -> None:
    row = key_repeats(df, key).first()
    if row.repeated_keys:
        raise DataQualityError(f"{row.repeated_keys} repeated values of key ({', '.join(key)})")
