"""Every registered query against its SQL, on the smallest tables."""

import datetime as dt
import math

import duckdb
import pytest

from tidewater.plans import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels
conversations""".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, (int, float)):
        return "NULL" if isinstance(value, float) and math.isnan(value) else repr(float(value))
    return value.isoformat() if isinstance(value, (dt.date, dt.datetime)) else str(value)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    found = duck.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(found.columns)
    order = [got.columns.index(c) for c in sorted(got.columns)]
    want_order = [found.columns.index(c) for c in sorted(found.columns)]
    rows = sorted([plain(r[i]) for i in order] for r in got.collect())
    wanted = sorted([plain(r[i]) for i in want_order] for r in found.fetchall())
    assert len(rows) > 0 or name.startswith("check_")
    assert rows == wanted
