"""Every registered query against its SQL in DuckDB, on whole tables."""

import math
from collections import Counter
from datetime import datetime

import duckdb
import pytest

from chatloom.plans.catalog import ORACLE_SQL, QUERIES

TABLES = ["events", "documents"]

DUCK_TYPES = {
    "BOOLEAN": "boolean",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "TIMESTAMP": "timestamp_ntz",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS FROM '{sf_dir}/{name}.parquet'")
    return connection


def normal(value):
    if isinstance(value, float):
        return round(value, 6) if math.isfinite(value) else str(value)
    if isinstance(value, datetime):
        return value.isoformat()
    return value


def as_bag(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(normal(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    expected = duck.execute(ORACLE_SQL[name])
    columns = [column[0] for column in expected.description]
    assert sorted(columns) == sorted(result.columns)
    types = {column[0]: DUCK_TYPES[str(column[1])] for column in expected.description}
    assert types == dict(result.dtypes)
    want = as_bag(columns, expected.fetchall())
    assert as_bag(result.columns, result.collect()) == want
    assert want
