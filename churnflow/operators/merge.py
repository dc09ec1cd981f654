"""Row-level writes, as joins on a key."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from churnflow.functions import date_literal


def survivors(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in the source. Only the source's keys take part in the join.

    Both sides are sorted and merged, by hint: stored keys are so well compressed that Spark, judging by the size of
    their files, would send millions of them to every task.
    """
    return target.join(source.select(*key).hint("merge"), list(key), "left_anti")


def upsert(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """The target with source rows added, or put in place of those with the same key.

    ``source`` must have the target's columns and one row per key: see ``require_unique_key``.
    Only keys are joined, so the source's other columns are never shuffled, and no task holds
    more keys than its share of them.
    """
    return source.select(*target.columns).unionByName(survivors(target, source, key))


def matched_keys(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """Source keys that already exist in the target."""
    return source.select(*key).join(target.select(*key), list(key), "left_semi")


def replace_slice(target: DataFrame, source: DataFrame, snapshot: date, model_version: str) -> DataFrame:
    """The target with one (snapshot, model version) slice replaced by ``source``."""
    inside = (F.col("snapshot_date") == date_literal(snapshot)) & (F.col("model_version") == F.lit(model_version))
    outside = target.filter(~F.coalesce(inside, F.lit(False)))
    return outside.unionByName(source.select(*target.columns))
