"""A stored feature table over the test data, as the weekly job leaves it for training and scoring."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from churnflow.plans import update_features
from churnflow.schemas import FEATURES
from churnflow.sources import Lake
from churnflow.sources.scratch import scratch_root
from workload.adapters import customer_sources

SNAPSHOT = date(2001, 6, 3)
WEEKS = [SNAPSHOT - timedelta(weeks=w) for w in range(8, -1, -1)]
RUN_TS = datetime(2024, 1, 20, 6, 0, 0)

_lakes: dict[tuple[str, str], Lake] = {}


def new_lake(spark: SparkSession) -> Lake:
    return Lake(spark, f"{scratch_root(spark)}/churnflow/lake-{uuid.uuid4().hex}")


def feature_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Built by the job on first use in a session: nine weekly snapshots of every customer."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _lakes:
        lake = new_lake(spark)
        update_features(lake, WEEKS, RUN_TS, customer_sources(spark, sf_dir))
        _lakes[key] = lake
    return _lakes[key]


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_lake(spark, sf_dir).read(FEATURES)
