"""Every registered query against its SQL twin, over whole tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from workload import batch, realtime

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def _normal(rows):
    def one(value):
        return repr(round(value, 9)) if isinstance(value, float) else repr(value)

    return sorted(tuple(one(v) for v in row) for row in rows)


def test_every_query_has_a_twin():
    assert {**batch.QUERIES, **realtime.QUERIES}.keys() <= entry.oracle_sql().keys() <= entry.queries().keys()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, duck, name):
    got = entry.queries()[name](spark, FOLDER)
    result = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(got.columns)
    expected = result.fetchall()
    assert expected
    assert _normal(got.select(*columns).collect()) == _normal(expected)
