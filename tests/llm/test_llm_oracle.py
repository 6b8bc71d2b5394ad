"""The llm queries that SQL can express, against another engine at the smallest scale."""

import duckdb
import pytest

from stockloom.llm import oracle, queries

SF_DIR = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _plain(value):
    return round(value, 12) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    df = queries.registry()[name](spark, SF_DIR)
    result = con.execute(oracle.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    key = lambda row: [(v is None, str(v)) for v in row]
    ours = sorted((tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=key)
    assert ours == sorted((tuple(map(_plain, r)) for r in result.fetchall()), key=key)


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.registry())
    assert numbers == list(range(1, 14))
