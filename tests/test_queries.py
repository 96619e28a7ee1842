"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from fieldguard.plans import catalog
from tools.check import TABLES, clean, key

DIR = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.QUERIES, catalog.SQL


@pytest.fixture(scope="module")
def con():
    link = duckdb.connect()
    for t in TABLES:
        link.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return link


def test_every_query_is_checked():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows(spark, con, name):
    df = QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    got = [tuple(clean(v) for v in r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    rel = con.sql(SQL[name])
    at = [rel.columns.index(c) for c in columns]
    want = [tuple(clean(r[i]) for i in at) for r in rel.fetchall()]
    assert sorted(rel.columns) == columns
    assert sorted(got, key=key) == sorted(want, key=key)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
