"""Every query with SQL against DuckDB on the smallest tables."""

from __future__ import annotations

import datetime
import glob
import os

import duckdb
import pytest

from kbspark.queries import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="session")
def db():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for p in glob.glob(f"{FOLDER}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    cur = db.execute(ORACLES[name])
    columns = [c[0] for c in cur.description]
    assert set(columns) == set(df.columns)
    want = sorted(repr(tuple(plain(dict(zip(columns, r))[c]) for c in df.columns)) for r in cur.fetchall())
    got = sorted(repr(tuple(plain(x) for x in r)) for r in df.collect())
    assert got == want


def test_every_query_has_a_stable_schema(spark):
    assert set(ORACLES) <= set(QUERIES)
