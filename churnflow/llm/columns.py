"""Small helpers shared by the text operators: input columns by name, and shared-folder tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from churnflow.sources.scratch import scratch_root


def require(df: DataFrame, *names: str) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the folder that driver and executors share."""
    return f"{scratch_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage, survives lost executors.

    Without a ``path`` of the caller's, who then deletes it, it goes at the end of the ``scratch`` block it was
    written in; outside of one it stays as long as the shared folder keeps it, since a result may still read it.
    """
    spark = df.sparkSession
    if path is None:
        path = shared_path(spark, name)
        if _scopes:
            _scopes[-1].append(path)
    # What the write shuffled is of no use to any later query, so it goes when the write is over.
    with settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_scopes: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """All that operators store during the block is deleted at its end, also on failure: write results within it."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for the time of a block; dots in names are written as two underscores."""
    names = {key.replace("__", "."): value for key, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
