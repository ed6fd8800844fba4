"""Every query that has SQL against DuckDB on the same tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from evgraph.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(None if r[i] is None or r[i] != r[i] else round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF)
    want = duck.execute(ORACLE[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    a, b = plain(got.collect(), got.columns), plain(want.fetchall(), columns)
    assert len(a) == len(b) and a == b


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
