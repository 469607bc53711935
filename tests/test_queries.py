"""Every query with SQL against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

from folioforge.plans.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return c


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v


def rows(names, found):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, con, name):
    got = QUERIES[name](spark, SF)
    want = con.sql(SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
