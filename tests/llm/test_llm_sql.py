"""The registered text queries against their SQL in another engine, on whole tables."""

from __future__ import annotations

import duckdb
import pytest

from churnflow.llm.oracle import ORACLE_SQL
from churnflow.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_agrees_with_sql(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    with duckdb.connect() as duck:
        for table in ("documents", "pages", "benchmark", "labels", "conversations"):
            duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
        cursor = duck.execute(ORACLE_SQL[name])
        names = [c[0] for c in cursor.description]
        want = sorted(map(repr, cursor.fetchall()))
    assert set(names) == set(df.columns)
    assert sorted(repr(tuple(r)) for r in df.select(*names).collect()) == want and want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_gives_a_row_for_each_input_row(spark, name):
    table = "pages" if name.startswith("op6_") else "documents"
    assert QUERIES[name](spark, SF_DIR).count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
