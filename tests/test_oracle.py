"""Every registered query against its SQL counterpart in another engine."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_point
import oracle_queries
from conftest import SF_DIR
from stockloom.queries import registry

QUERIES = registry()
ORACLE = oracle_queries.oracle_sql()
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
TYPES = {
    "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda t: [(v is None, str(type(v)), "" if v is None else v) for v in t])


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]) for c in result.description}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == kinds
    assert _normal(df.collect(), df.columns) == _normal(result.fetchall(), columns)


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() == 25
    assert df.columns[0] == "category_id"
