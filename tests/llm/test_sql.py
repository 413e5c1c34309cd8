"""Queries with SQL give in Spark what DuckDB gives."""

import pytest

from firelark.llm import queries


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_same_as_sql(spark, sf, name):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    rel = c.execute(queries.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    df = queries.queries()[name](spark, sf)
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*names).collect()), key=repr) == sorted(rel.fetchall(), key=repr)
