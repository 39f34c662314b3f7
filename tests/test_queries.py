"""Every registered query against its SQL twin in DuckDB."""

import math
import os
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = [p.stem for p in Path(SF_DIR).glob("*.parquet")]

SQL_TYPES = {
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "int": "INTEGER",
    "string": "VARCHAR",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def _key(row):
    return tuple((v is None, 0 if v is None else v) for v in row)


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b and type(a) is type(b)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(name, spark, duck):
    df = queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    rows = sorted((tuple(r) for r in df.select(*columns).collect()), key=_key)
    assert rows
    sql = oracle_sql().get(name)
    if sql is None:
        return
    result = duck.sql(f'SELECT {", ".join(chr(34) + c + chr(34) for c in columns)} FROM ({sql})')
    expected = sorted(result.fetchall(), key=_key)
    relation = duck.sql(sql)
    assert sorted(relation.columns) == columns
    types = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    assert {c: SQL_TYPES[t] for c, t in df.dtypes} == types
    assert len(rows) == len(expected)
    for got, want in zip(rows, expected):
        assert all(_same(g, w) for g, w in zip(got, want)), (got, want)


def test_names_match():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
