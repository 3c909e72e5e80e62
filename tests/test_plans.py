"""What the plans must look like to hold at scale."""

from __future__ import annotations

import os
import re

import __spark_entry__ as entry_point
import pytest

from pyspark.sql import functions as F

from parcelscope.plans.measures import evaluate
from parcelscope.settings import PARTITION_BYTES, configure, scratch_dir, scratch_run, shuffle_partitions, staged

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")

LAZY = sorted(
    k
    for k in entry_point.queries()
    if k[:3] in ("sv_", "gd_", "me_", "rl_", "an_") or k in ("qc_bronze", "qc_silver", "qc_summary")
)


def plan_of(spark, name: str) -> str:
    df = entry_point.queries()[name](spark, FOLDER)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when every table is too big to broadcast."""
    configure(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_cross_join(spark, name):
    plan = plan_of(spark, name)
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "ExistingRDD"):
        assert node not in plan, node


def test_mark_reaches_the_scan(spark):
    plan = plan_of(spark, "in_incremental_orders")
    assert "GreaterThanOrEqual(o_orderdate,1998-07-01" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_unused_reviews_and_coordinates_are_not_read(spark):
    plan = plan_of(spark, "me_revenue_by_year_state")
    assert "event_id" not in plan
    assert "c_acctbal" not in plan


def test_row_level_measures_skip_the_order_grain(spark):
    plan = plan_of(spark, "me_seller_sla")
    assert "o_totalprice" not in plan
    assert not re.search(r"HashAggregate\(keys=\[seller_id#\d+, order_id", plan)


def test_nothing_is_broadcast_by_hint_without_hot_keys(spark, no_broadcast):
    plan = plan_of(spark, "gd_fact_orders").split("== Initial Plan ==")[-1]
    assert "BroadcastExchange" not in plan


def test_the_fact_does_not_look_its_own_customers_up(spark, no_broadcast):
    """38 hash exchanges with the look-up; items are scanned no more than before."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(spark, "gd_fact_orders")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(re.findall("Exchange hashpartitioning", plan)) <= 32
    assert len(re.findall(r"FileScan[^\n]*lineitem", plan)) <= 3


def test_year_over_year_does_not_shuffle_the_fact_by_date(spark, no_broadcast):
    plan = plan_of(spark, "me_revenue_yoy").split("== Initial Plan ==")[-1]
    assert "Exchange hashpartitioning(order_date_key" not in plan


def test_fact_moves_wide_item_rows_three_times(spark, no_broadcast):
    """Once per id the items are matched on: seller, product, order."""
    plan = plan_of(spark, "gd_fact_orders")
    for key in ("seller_id", "product_id", "order_id"):
        assert re.search(rf"Exchange hashpartitioning\({key}#", plan)


def test_shuffle_partitions_follow_the_input():
    assert shuffle_partitions(0, 8) == 8
    assert shuffle_partitions(100 * 2**40, 4000) == 548_000
    assert shuffle_partitions(10 * PARTITION_BYTES + 1, 4) == 12


def test_scratch_is_in_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(base)
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")
    df = staged(spark.range(5), "y")
    assert df.count() == 5 and "FileScan parquet" in df._jdf.queryExecution().toString()


def test_a_hot_seller_is_split(spark, no_broadcast):
    """A third of the fact on one seller: the join to the dimension runs in several tasks for it."""
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    settings = {
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        seller = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000)
        fact = spark.range(0, 300_000, numPartitions=8).select(
            F.md5(seller.cast("string")).alias("seller_key"),
            F.md5(F.col("id").cast("string")).alias("order_id"),
            (F.col("id") % 2).cast("smallint").alias("is_late"),
        )
        sellers = spark.range(5000).select(
            F.md5(F.col("id").cast("string")).alias("seller_key"),
            (F.col("id") % 27).cast("string").alias("seller_state"),
        )
        result = evaluate(
            {"fact_orders": fact, "dim_sellers": sellers},
            ["late_orders", "total_orders"],
            by=["dim_sellers.seller_state"],
        )
        found = result.collect()
        assert sum(r["late_orders"] for r in found) == 150_000
        assert sum(r["total_orders"] for r in found) == 300_000
        assert "SortMergeJoin(skew=true)" in result._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        for key in settings:
            spark.conf.unset(key)


def test_a_run_removes_what_it_staged(spark, tmp_path):
    kept = staged(spark.range(3), "kept")
    with scratch_run(spark, "outer"):
        outer = staged(spark.range(4), "a")
        with scratch_run(spark, "inner"):
            inner = scratch_dir(spark, "b")
            staged(spark.range(5), "b")
        assert outer.count() == 4 and not os.path.exists(os.path.dirname(inner))
        gone = os.path.dirname(scratch_dir(spark, "c"))
        assert os.path.exists(gone)
    assert not os.path.exists(gone) and kept.count() == 3
    with pytest.raises(RuntimeError):
        with scratch_run(spark, "dies"):
            gone = os.path.dirname(scratch_dir(spark, "d"))
            staged(spark.range(1), "d")
            raise RuntimeError("lost")
    assert not os.path.exists(gone)
