"""Every registered query against its SQL counterpart in DuckDB."""

import math

import duckdb
import pytest

from reviewlab.plans.oracle import ORACLE
from reviewlab.plans.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
NEEDS_STOPWORDS = {"remove_stopwords", "clean_full", "stopword_anti_join"}
# models and user functions, which SQL cannot express
ROWS_ONLY = set(QUERIES) - set(ORACLE) - NEEDS_STOPWORDS


@pytest.fixture(scope="session")
def duck(sf):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return connection


@pytest.fixture(scope="session")
def statements(spark):
    from reviewlab.plans.oracle import oracle_sql

    return oracle_sql()


def comparable(frame):
    def shown(value):
        if value is None or (isinstance(value, float) and math.isnan(value)):
            return "null"
        return repr(float(value)) if isinstance(value, float) else str(value)

    ordered = frame[sorted(frame.columns)]
    return sorted(tuple(shown(v) for v in row) for row in ordered.itertuples(index=False, name=None))


SPARK_TYPES = {"BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}


@pytest.mark.parametrize("name", sorted(set(ORACLE) | NEEDS_STOPWORDS))
def test_query_equals_sql(spark, sf, duck, statements, name):
    result = QUERIES[name](spark, sf)
    cursor = duck.execute(statements[name])
    types = {c[0]: SPARK_TYPES.get(str(c[1])) for c in cursor.description}
    assert dict(result.dtypes).keys() == types.keys()
    expected = cursor.df()
    assert comparable(result.toPandas()) == comparable(expected)


def test_every_query_has_sql():
    assert not ROWS_ONLY
