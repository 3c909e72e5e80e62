from __future__ import annotations

import pytest
from conftest import order, rows

from parcelscope.plans.footers import footer_frame, footer_totals, suite_from_footers
from parcelscope.plans.quality import bronze_suite
from parcelscope.schemas import BRONZE, DOUBLE, INT, STRING, struct


def test_counts_nulls_and_bounds_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = struct(("a", INT), ("b", DOUBLE), ("c", STRING))
    given = [(i, None if i % 3 == 0 else i / 2, None if i % 7 == 0 else "x" * i) for i in range(1, 100)]
    spark.createDataFrame(given, schema).repartition(3).write.parquet(path)
    frame = footer_frame(spark, path, schema, ("a", "b"))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(a), COUNT(b), COUNT(c), MIN(a), MAX(a), MIN(b), MAX(b)]" in plan
    got = footer_totals(spark, path, schema, ("a", "b")).first().asDict()
    assert got == {"n": 99, "nulls_a": 0, "nulls_b": 33, "nulls_c": 14, "min_a": 1, "max_a": 99, "min_b": 0.5, "max_b": 49.0}
    with pytest.raises(ValueError):
        footer_frame(spark, path, schema, ("c",))


@pytest.mark.parametrize("items", [[("o1", 1), ("o1", 1), ("o2", 1)], [("o1", None), (None, None), (None, 2)], []])
def test_the_suite_equals_the_scanned_one(spark, bronze, tmp_path, items):
    tables = {
        "orders": bronze("orders", order("o1", bought="2017-01-01"), order("o2", bought="2018-01-01 03:04:05"), order(None)),
        "order_items": bronze("order_items", *[{"order_id": o, "order_item_id": n} for o, n in items]),
        "geolocation": bronze("geolocation", {"geolocation_zip_code_prefix": 1}, {}, {}),
    }
    paths = {t: str(tmp_path / t) for t in tables}
    for t, df in tables.items():
        df.write.parquet(paths[t])
    expected = {t: len(items) or 1 for t in tables}
    stored = {t: spark.read.schema(BRONZE[t]).parquet(paths[t]) for t in tables}
    assert rows(suite_from_footers(spark, paths, expected)) == rows(bronze_suite(stored, expected))
