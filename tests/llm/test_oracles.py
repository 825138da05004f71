"""Queries that SQL can express equal their DuckDB statements."""

import duckdb
import pytest

from lexis.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_equals_sql(spark, sf, key):
    con = duckdb.connect()
    for name in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    rel = con.sql(ORACLE[key])
    df = QUERIES[key](spark, sf)
    assert sorted(df.columns) == sorted(rel.columns)
    got = sorted(tuple(r[c] for c in rel.columns) for r in df.collect())
    assert got == sorted(rel.fetchall())
