"""Intermediate tables, written once and read back, in storage every executor can reach.

A written table cuts the lineage and survives the loss of executors.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local_root: str | None = None


def scratch_root(spark: SparkSession) -> str:
    """The session's shared folder; a temporary one only for a single-machine session without it."""
    global _local_root
    configured = spark.conf.get(_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="churnflow-")
    return _local_root


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and return a reader of what was written."""
    return _write(df, new_path(df.sparkSession, name))


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``stage`` for the time of a block: the written table is removed afterwards, also on failure."""
    path = new_path(df.sparkSession, name)
    try:
        yield _write(df, path)
    finally:
        remove(df.sparkSession, path)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/churnflow/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
