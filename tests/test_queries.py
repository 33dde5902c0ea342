"""Every registered query of the library against its SQL in DuckDB, on the smallest tables."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from voltaria.queries import ORACLE_SQL, QUERIES

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(D):
        c.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{D}/{f}')")
    return c


def cell(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return ""
    if isinstance(v, float):
        return repr(round(v, 9) + 0.0)
    return str(v.replace(tzinfo=None) if isinstance(v, dt.datetime) else v)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, D)
    columns = sorted(df.columns)
    got = sorted(tuple(cell(r[c]) for c in columns) for r in df.collect())
    rel = duck.sql(ORACLE_SQL[name])
    names = list(rel.columns)
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted(tuple(cell(r[k]) for k in order) for r in rel.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
