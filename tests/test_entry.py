"""Every registered query beside its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, canonical
from checks.queries import QUERIES

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(SQL) >= set(QUERIES) and set(entry.queries()) >= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    got = canonical(df.columns, df.collect())
    res = con.execute(SQL[name])
    assert got == canonical([c[0] for c in res.description], res.fetchall())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() == 10 and df.schema == entry.entry(spark).schema
