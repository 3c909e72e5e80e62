"""Every registered query against its SQL oracle, value by value, over whole tables."""

from __future__ import annotations

import os

import __spark_entry__ as entry_point
import pytest
from compare import connect, oracle_rows, spark_rows

from parcelscope.oracle import ORACLES as SHOP_ORACLES
from parcelscope.suite import QUERIES as SHOP_QUERIES

FOLDER = os.environ.get("PARCELSCOPE_TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = connect(FOLDER)
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(SHOP_QUERIES) == set(SHOP_ORACLES)


@pytest.mark.parametrize("name", sorted(SHOP_QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = spark_rows(entry_point.queries()[name](spark, FOLDER))
    want = oracle_rows(duck, entry_point.oracle_sql()[name])
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["year", "customer_state", "total_revenue", "total_orders", "on_time_rate"]
    assert df.count() > 0
