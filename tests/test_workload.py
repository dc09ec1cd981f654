"""Every registered query against its SQL in another engine, on whole tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_points
from workload.oracle import ORACLE_SQL as ORACLE
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")
TYPES = {"BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "DATE": "date", "BOOLEAN": "boolean"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLE[name])
    names, types = [c[0] for c in cursor.description], [str(c[1]) for c in cursor.description]
    assert dict(df.dtypes) == {n: TYPES[t] for n, t in zip(names, types)}
    want = sorted(map(repr, cursor.fetchall()))
    assert sorted(repr(tuple(r)) for r in df.select(*names).collect()) == want and want


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() == 150 and "labeled_churn" in df.columns
