"""Every query with SQL against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

NAMES = [n for n in entry.oracle_sql() if n not in entry.queries() or not n.startswith("op")]


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, float):
        return round(v, 7)
    return v


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf_dir}/{f}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    want = duck.sql(entry.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
