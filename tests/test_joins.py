from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from parcelscope.operators.dedupe import latest_per_key
from parcelscope.operators.joins import hot_keys, orphan_keys, spread_join


@pytest.fixture
def skewed(spark):
    """A third of the rows on one key."""
    many = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 500).alias("k"), "id"
    )
    one = spark.range(-1, 400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    return many, one


def test_hot_keys_finds_only_the_hot_one(skewed):
    many, _ = skewed
    assert rows(hot_keys(many, "k", ["k", "id"], hot_rows=1000, one_in=10), "k") == [(-1,)]


def test_hot_keys_do_not_depend_on_partitioning(skewed):
    many, _ = skewed
    found = [
        rows(hot_keys(many.repartition(n), "k", ["k", "id"], hot_rows=20, one_in=5)) for n in (1, 3, 8)
    ]
    assert found[0] == found[1] == found[2] and len(found[0]) > 1


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_rows", [10, 1000, 10**9])
@pytest.mark.parametrize("most_listed", [0, 10_000])
def test_spread_join_equals_plain_join(skewed, how, hot_rows, most_listed):
    many, one = skewed
    hot = hot_keys(many, "k", ["k", "id"], hot_rows=hot_rows, one_in=10)
    spread = spread_join(many, one, hot, "k", ["k", "id"], how, most_listed=most_listed)
    assert rows(spread, "k", "id", "v") == rows(many.join(one, "k", how), "k", "id", "v")


def test_spread_join_with_repeated_right_rows(skewed):
    many, one = skewed
    twice = one.unionAll(one)
    hot = hot_keys(many, "k", ["k", "id"], hot_rows=1000, one_in=10)
    assert spread_join(many, twice, hot, "k", ["k", "id"]).count() == (
        many.join(twice, "k").count()
    )


def test_spread_join_spreads_the_hot_key(spark, skewed):
    many, one = skewed
    hot = hot_keys(many, "k", ["k", "id"], hot_rows=50, one_in=10)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plain = many.join(one, "k").where("k = -1").groupBy(F.spark_partition_id()).count()
        spread = (
            spread_join(many, one, hot, "k", ["k", "id"])
            .where("k = -1")
            .groupBy(F.spark_partition_id())
            .count()
        )
        assert plain.count() == 1
        assert spread.count() == 4  # all shuffle partitions
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_a_small_share_is_hot_all_the_same(spark):
    """Hot by its rows alone, however many other rows there are; salts follow the count."""
    many = spark.range(30_000).select(
        F.when(F.col("id") < 900, -1).when(F.col("id") < 1200, -2).otherwise(F.col("id")).alias("k"), "id"
    )
    found = dict(rows(hot_keys(many, "k", ["id"], hot_rows=100, one_in=2)))
    assert set(found) == {-1, -2} and found[-1] in range(8, 11) and found[-2] in range(2, 5)


def test_null_keys_of_a_left_join_are_spread(spark):
    many = spark.range(2000).select(F.when(F.col("id") < 1990, None).otherwise(F.col("id")).alias("k"), "id")
    one = spark.range(1990, 1995).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for hot_rows in (1, 10**9):
            joined = spread_join(many, one, hot_keys(many, "k", ["id"], hot_rows, 1), "k", ["id"], "left")
            assert joined.count() == 2000 and joined.where("v = 1").count() == 5
            placed = joined.withColumn("p", F.spark_partition_id()).where("k IS NULL")
            assert placed.groupBy("p").count().count() == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_spread_join_refuses_other_kinds(skewed):
    many, one = skewed
    with pytest.raises(ValueError):
        spread_join(many, one, hot_keys(many, "k", ["k"]), "k", ["id"], "full")


def test_orphans_count_rows_and_include_null(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,), (None,)], "k string")
    parent = spark.createDataFrame([("a",), (None,)], "p string")
    assert rows(orphan_keys(child, "k", parent, "p")) == [("b", 2), (None, 2)]


def test_latest_per_key_orders_nulls_last_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [("x", None, 9), ("x", 1, 2), ("y", 5, 1), ("y", 5, 3), ("z", None, None)],
        "k string, t int, v int",
    )
    assert rows(latest_per_key(df, ["k"], [F.col("t")], ["v"])) == [("x", 2), ("y", 3), ("z", None)]
