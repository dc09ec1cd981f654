"""The churn label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

INACTIVE_DAYS = 60


def days_since(last_activity: Column, snapshot: Column) -> Column:
    """Whole days from the last activity to the snapshot; negative for activity after it."""
    return F.date_diff(snapshot, F.coalesce(last_activity, snapshot))


def churn_label(outcome: Column, snapshot: Column, last_activity: Column) -> Column:
    """A known outcome wins; otherwise 1 after 60 days without activity, or without any activity."""
    inactive = last_activity.isNull() | (F.date_diff(snapshot, last_activity) >= INACTIVE_DAYS)
    return F.coalesce(outcome, F.when(inactive, 1).otherwise(0))


def with_labels(activity: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Label rows of (customer_id, snapshot_date, last_activity_date), one known outcome per customer.

    ``outcomes`` must hold each customer once: see ``require_unique_key``. A repeated customer
    would repeat rows.
    """
    known = outcomes.select(F.col("cus_cust_id_buy").alias("customer_id"), F.col("churn").alias("outcome"))
    snapshot, last = F.col("snapshot_date"), F.col("last_activity_date")
    return activity.join(known, "customer_id", "left").select(
        *activity.columns,
        days_since(last, snapshot).alias("days_since_activity"),
        churn_label(F.col("outcome"), snapshot, last).alias("labeled_churn"),
    )
