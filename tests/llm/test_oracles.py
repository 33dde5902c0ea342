"""The numbered queries that SQL can express against DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

from voltaria.llm import queries

D = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, name):
    duck = duckdb.connect()
    for f in os.listdir(D):
        duck.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{D}/{f}')")
    df = queries.QUERIES[name](spark, D)
    rel = duck.sql(queries.oracle_sql()[name])
    names, columns = list(rel.columns), sorted(df.columns)
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    text = lambda row: tuple(map(str, row))
    assert sorted(text(r[c] for c in columns) for r in df.collect()) == sorted(text(r[k] for k in order) for r in rel.fetchall())
