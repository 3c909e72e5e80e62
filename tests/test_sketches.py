from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from parcelscope.plans.sketches import COUNTED, distinct_from_sketches, sketched, store_sketches
from parcelscope.sources.lake import Lake


@pytest.fixture
def model(spark):
    """Orders of many items over 60 days, three states and four categories; some reach over groups."""
    n = spark.range(200_000)
    fact = n.select(
        F.concat(F.lit("o"), F.floor(F.col("id") / 3)).alias("order_id"),
        F.concat(F.lit("c"), F.pmod(F.xxhash64(F.floor(F.col("id") / 3)), F.lit(20_000))).alias("customer_key"),
        F.concat(F.lit("p"), F.pmod(F.col("id"), F.lit(5))).alias("product_key"),
        F.when(F.col("id") < 190_000, F.lit(20170101) + F.pmod(F.col("id"), F.lit(28))).alias("order_date_key"),
    )
    customers = fact.select("customer_key").distinct().withColumn("customer_state", F.substring("customer_key", 2, 1))
    products = spark.createDataFrame([(f"p{i}", f"k{i % 3}") for i in range(4)], "product_key string, product_category_english string")
    dates = spark.range(28).select(
        (F.lit(20170101) + F.col("id")).cast("int").alias("date_key"), F.floor(F.col("id") / 7).alias("week")
    )
    return {"fact_orders": fact.withColumn("order_date_key", F.col("order_date_key").cast("int")),
            "dim_customers": customers, "dim_products": products, "dim_date": dates}


@pytest.mark.parametrize(
    "by, where",
    [
        ([], {}), (["dim_date.week"], {}), (["dim_customers.customer_state", "dim_products.product_category_english"], {}),
        (["dim_products.product_category_english"], {"dim_date.week": [0, 2], "dim_customers.customer_state": "1"}),
    ],
)
def test_estimates_are_near_exact_counts_and_leave_the_fact_alone(spark, model, tmp_path, by, where):
    lake = Lake(spark, str(tmp_path / "lake"), prefix=f"k{uuid.uuid4().hex[:8]}_")
    stored = store_sketches(lake, model, log_size=12)
    got = distinct_from_sketches(stored, model["dim_date"], list(COUNTED), by, where)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Range (0, 200000" not in plan and "distinct_sketches" in plan
    rows = model["fact_orders"]
    for dim, key, fact_key in (("dim_customers",) + ("customer_key",) * 2, ("dim_products",) + ("product_key",) * 2,
                               ("dim_date", "date_key", "order_date_key")):
        rows = rows.join(model[dim].withColumnRenamed(key, fact_key), fact_key, "left")
    for axis, value in where.items():
        rows = rows.where(F.col(axis.split(".")[1]).isin(value))
    names = [a.split(".")[1] for a in by]
    exact = rows.groupBy(*names).agg(*[F.count_distinct(c).alias(m) for m, c in COUNTED.items()]).collect()
    found = {tuple(r[n] for n in names): r for r in got.collect()}
    assert len(found) == len(exact) > 0
    for r in exact:
        for m in COUNTED:
            assert abs(found[tuple(r[n] for n in names)][m] - r[m]) <= 0.06 * r[m]


def test_axes_outside_the_grain_are_refused(model):
    with pytest.raises(ValueError):
        distinct_from_sketches(sketched(model), model["dim_date"], list(COUNTED), ["dim_sellers.seller_id"])
