"""Every registered query against its DuckDB statement (rows, columns,
order-insensitive values) on the smallest driver tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as E
from quayside.plans.feed_standins import FEED_QUERIES
from quayside.plans.standins import QUERIES
from oracle_check import digest, duck

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SMALL)
    s = digest(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(E.oracle_sql()[name])
    d = digest([c[0] for c in rel.description], rel.fetchall())
    assert s[2] == d[2], "columns differ"
    assert s[0] == d[0], "row counts differ"
    assert s[1] == d[1], "values differ"


def test_every_query_has_an_oracle():
    assert {*QUERIES, *FEED_QUERIES} <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "rtl_trip_id" not in df.columns and len(df.columns) == 13
