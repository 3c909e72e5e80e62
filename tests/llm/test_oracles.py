"""Queries that SQL can express against DuckDB."""

from __future__ import annotations

import pytest
from compare import connect, oracle_rows, spark_rows

from parcelscope.llm.oracle import ORACLES
from parcelscope.llm.suite import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    got = spark_rows(QUERIES[name](spark, FOLDER))
    assert got == oracle_rows(connect(FOLDER), ORACLES[name])
