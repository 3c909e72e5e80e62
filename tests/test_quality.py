from __future__ import annotations

from decimal import Decimal

import pytest
from conftest import order, rows
from pyspark.sql import functions as F

from parcelscope.plans import quality
from parcelscope.plans.silver import Silver
from parcelscope.schemas import BRONZE, GOLD


@pytest.fixture
def empty(spark):
    return lambda table: spark.createDataFrame([], BRONZE[table])


def verdicts(suite):
    return {(r["table_name"], r["check_type"]): (r["result"], r["passed"]) for r in suite.collect()}


def test_bronze_checks(spark, bronze):
    tables = {
        "orders": bronze("orders", order("1"), order("1"), {**order("x"), "order_id": None}),
        "order_items": bronze(
            "order_items", {"order_id": "1", "order_item_id": 1}, {"order_id": "1", "order_item_id": 2}
        ),
        "order_reviews": bronze("order_reviews", {"order_id": "1"}, {"order_id": "1"}),
    }
    reviews_at_source = spark.range(2).groupBy().count()
    got = verdicts(
        quality.bronze_suite(tables, {"orders": 3, "order_items": 3, "order_reviews": reviews_at_source})
    )
    assert got == {
        ("orders", "row_count"): ("3 rows for about 3 (off by 0.0%)", True),
        ("orders", "pk_null_rate"): ("1 nulls in order_id", False),
        ("orders", "pk_duplicates"): ("1 duplicates on order_id", False),
        ("orders", "date_range"): ("2017-03-01 00:00:00 to 2017-03-01 00:00:00", True),
        ("order_items", "row_count"): ("2 rows for about 3 (off by 33.3%)", False),
        ("order_items", "pk_null_rate"): ("0 nulls in order_id, order_item_id", True),
        ("order_items", "pk_duplicates"): ("0 duplicates on order_id, order_item_id", True),
        ("order_reviews", "row_count"): ("2 rows for about 2 (off by 0.0%)", True),
        ("order_reviews", "pk_null_rate"): ("2 nulls in review_id", True),
        ("order_reviews", "pk_duplicates"): ("skipped, key not unique by design", True),
        ("order_reviews", "date_range"): ("none to none", True),
    }


def test_unknown_expectation_fails(bronze):
    got = verdicts(quality.bronze_suite({"sellers": bronze("sellers", {"seller_id": "s"})}, {}))
    assert got[("sellers", "row_count")][1] is False


def test_silver_checks(bronze, empty):
    made = {
        "orders": bronze(
            "orders", order("1", "c1", "2017-01-01", "2018-06-01", "2017-02-01"),
            {**order("2"), "customer_id": None},
        ),
        "order_items": bronze(
            "order_items",
            {"order_id": "1", "seller_id": "s", "product_id": "p", "price": Decimal("90.00"),
             "freight_value": Decimal("10.00")},
            {"order_id": "9", "seller_id": "t"},
        ),
        "order_payments": bronze(
            "order_payments",
            {"order_id": "1", "payment_type": "boleto", "payment_value": Decimal("130.00")},
            {"order_id": "1", "payment_type": "odd", "payment_value": Decimal("-1.00")},
        ),
        "customers": bronze("customers", {"customer_id": "c1"}),
        "sellers": bronze("sellers", {"seller_id": "s"}),
        "products": bronze("products", {"product_id": "p"}),
    }
    silver = Silver(lambda t: made.get(t) if t in made else empty(t))
    got = verdicts(
        quality.silver_suite(
            {t: silver[t] for t in silver}, {t: 2 for t in silver if t != "geolocation"},
            orphan_tolerance=1, revenue_tolerance=0.30,
        )
    )
    assert got[("orders", "null_rate_customer_id")] == ("1 nulls (50.00%)", False)
    assert got[("orders", "null_rate_order_id")] == ("0 nulls (0.00%)", True)
    assert got[("order_reviews", "null_rate_order_id")] == ("0 nulls (0.00%)", True)  # empty table
    assert got[("order_reviews", "range_review_score")] == ("no rows", True)
    assert got[("orders", "range_delivery_days")] == ("min=516, max=516", False)
    assert got[("order_payments", "range_payment_value")] == ("min=-1.00, max=130.00", False)
    assert got[("order_items", "ref_integrity_order_id")] == ("1 keys without a parent", True)
    assert got[("order_items", "ref_integrity_product_id")] == ("1 keys without a parent", True)  # the null
    assert got[("order_payments", "revenue_reconciliation")] == (
        "payments=129.00, items=100.00, variance=29.00%", True
    )
    assert got[("order_payments", "payment_type_valid_flag")] == (
        "1 payments of an unlisted type, of 2", True
    )
    assert got[("customers", "row_count_reconciliation")] == ("bronze 2, silver 1", True)
    assert got[("geolocation", "row_count_reconciliation")] == ("deduplicated, silver 0", True)


def test_more_silver_than_bronze_fails(bronze):
    orders = Silver(lambda t: bronze("orders", order("1"), order("2")))["orders"]
    got = verdicts(quality._silver_table("orders", orders, 1, 50).toDF(
        "table_name", "check_type", "result", "passed"))
    assert got[("orders", "row_count_reconciliation")] == ("bronze 1, silver 2", False)


def test_gold_checks(spark, bronze):
    schema = GOLD["fact_orders"]

    def fact_row(**values):
        base = {"order_id": "1", "customer_key": "c", "seller_key": "s", "product_key": "p",
                "order_date_key": 20170101, "payment_value": Decimal("10.00"), "review_score": 5}
        return tuple({**base, **values}.get(n) for n in schema.fieldNames())

    fact = spark.createDataFrame(
        [
            fact_row(),
            fact_row(customer_key="other", review_score=None),
            fact_row(customer_key="other", order_id="2", seller_key=None, review_score=9),
            fact_row(order_date_key=None, delivery_date_key=20300101),
        ],
        schema,
    )
    gold = {
        "fact_orders": fact,
        "dim_customers": spark.createDataFrame([("c",)], "customer_key string"),
        "dim_sellers": spark.createDataFrame([("s",)], "seller_key string"),
        "dim_products": spark.createDataFrame([("p",)], "product_key string"),
        "dim_date": spark.createDataFrame([(20170101,)], "date_key int"),
    }
    silver = {
        "order_items": bronze(
            "order_items", {"order_id": "1"}, {"order_id": "1"}, {"order_id": "2"}
        ),
        "order_payments": bronze(
            "order_payments",
            {"order_id": "1", "payment_value": Decimal("10.00")},
            {"order_id": "2", "payment_value": Decimal("10.00")},
            {"order_id": "3", "payment_value": Decimal("70.00")},  # paid, no items
        ),
    }
    got = verdicts(quality.gold_suite(gold, silver, null_score_tolerance=1))
    assert got == {
        ("fact_orders", "fact_vs_silver_order_items"): ("fact 4, silver 3", False),
        ("fact_orders", "null_customer_key"): ("0 nulls", True),
        ("fact_orders", "null_seller_key"): ("1 nulls", False),
        ("fact_orders", "null_product_key"): ("0 nulls", True),
        ("fact_orders", "null_order_date_key"): ("1 nulls", False),
        ("fact_orders", "review_score_out_of_range"): ("1 rows", False),
        ("fact_orders", "review_score_null_count"): ("1 rows (up to 1 tolerated)", True),
        ("fact_orders", "customer_key_orphans"): ("2 orphans", False),
        ("fact_orders", "seller_key_orphans"): ("1 orphans", False),
        ("fact_orders", "product_key_orphans"): ("0 orphans", True),
        ("fact_orders", "order_date_key_orphans"): ("0 orphans", True),
        ("fact_orders", "delivery_date_key_orphans"): ("1 orphans", False),
        ("fact_orders", "estimated_delivery_date_key_orphans"): ("0 orphans", True),
        ("fact_orders", "revenue_reconciliation"): (
            "fact=20.00, silver=20.00, variance=0.0000%", True
        ),
    }
    suite = quality.gold_suite(gold, silver)
    assert rows(quality.summary(suite)) == [(False, 7), (True, 7)]
    assert quality.failures(suite).count() == 7


def test_lengths_and_unique_keys(spark):
    df = spark.createDataFrame([("SP", "a"), ("RIO", "a")], "state string, k string")
    assert rows(quality.too_long(df, "t", {"state": 2, "k": 1})) == [
        ("t", "length_k", "0 values over 1", True),
        ("t", "length_state", "1 values over 2", False),
    ]
    assert rows(quality.unique_keys(df, "t", "k")) == [("t", "unique_k", "1 repeats", False)]
    assert quality.stamped(quality.unique_keys(df, "t", "k")).where(
        F.col("run_timestamp").isNotNull()
    ).count() == 1
