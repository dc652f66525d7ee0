"""Registered queries against DuckDB on the same tables."""

import duckdb
import pytest

from reviewlab.llm.oracle import ORACLE
from reviewlab.llm.queries import QUERIES

TABLES = ["documents", "benchmark", "pages", "labels"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    expected = connection.execute(ORACLE[name])
    columns = [c[0] for c in expected.description]
    result = QUERIES[name](spark, sf)
    assert sorted(result.columns) == sorted(columns)
    rows = [tuple(r) for r in result.select(*columns).collect()]
    assert sorted(rows, key=repr) == sorted(expected.fetchall(), key=repr)
