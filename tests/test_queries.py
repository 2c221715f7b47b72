"""Every registered query against its DuckDB counterpart on the smallest data."""

import duckdb
import pytest

import __spark_entry__ as entry
from verification import catalog, standins

SF_DIR = "/root/testdata/sf0.001"
QUERIES = catalog.spark_queries()
ORACLES = catalog.duckdb_queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in standins.BASE_TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    relation = duck.execute(ORACLES[name])
    names = [d[0] for d in relation.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted(repr(tuple(r[i] for i in order)) for r in relation.fetchall())
    assert got == expected


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
