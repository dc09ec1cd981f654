"""Reads: parameterised queries, one snapshot, a trailing window, literal rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from churnflow.functions import date_literal


def param_query(spark: SparkSession, query: str, params: Mapping[str, object] | None = None, **tables: DataFrame) -> DataFrame:
    """Run SQL with ``:name`` parameters; ``{name}`` refers to a DataFrame given by keyword.

    Values are bound, never pasted into the text. An empty result keeps its columns.
    """
    return spark.sql(query, args=dict(params or {}), **tables)


def read_snapshot(features: DataFrame, snapshot: date) -> DataFrame:
    """The rows of one snapshot date; prunes to one directory of the stored table."""
    return features.filter(F.col("snapshot_date") == date_literal(snapshot))


def window_start(end: date, lookback_weeks: int = 8) -> date:
    return end - timedelta(weeks=lookback_weeks)


def read_window(features: DataFrame, end: date, lookback_weeks: int = 8) -> DataFrame:
    """Snapshots from ``lookback_weeks`` weeks before ``end`` up to ``end``, both included."""
    first = window_start(end, lookback_weeks)
    return features.filter(F.col("snapshot_date").between(date_literal(first), date_literal(end)))


def literal_rows(spark: SparkSession, rows: Iterable[tuple], schema: StructType) -> DataFrame:
    """Rows written out in code, with declared types. For seeds and small lookups only."""
    return spark.createDataFrame(list(rows), schema)
