"""The operators that have SQL against DuckDB."""

import time

import duckdb
import pytest

from evgraph.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    began = time.time()
    found = con.execute(queries.oracle_sql()[name])
    columns, want = [d[0] for d in found.description], sorted(found.fetchall())
    assert time.time() - began < 60
    assert sorted(map(tuple, queries.queries()[name](spark, SF).select(*columns).collect())) == want
