from __future__ import annotations

from decimal import Decimal

from conftest import order, rows, ts
from pyspark.sql import functions as F

from parcelscope.functions.cleaning import to_long
from parcelscope.plans import silver


def test_undelivered_order_is_not_late_and_has_no_days(bronze):
    out = silver.orders(bronze("orders", order("1", due="2017-03-10")))
    assert rows(out, "delivery_days", "is_late", "days_late", "is_delivered") == [(None, 0, None, 0)]


def test_delivery_days_are_whole_24_hour_periods(bronze):
    out = silver.orders(
        bronze(
            "orders",
            order("1", bought="2017-01-01 18:00:00", delivered="2017-01-03 06:00:00", due="2017-01-09"),
            order("2", bought="2017-01-03 06:00:00", delivered="2017-01-01 18:00:00", due="2017-01-09"),
        )
    )
    assert rows(out, "order_id", "delivery_days") == [("1", 1), ("2", -1)]


def test_delivery_half_a_day_before_the_estimate_is_zero_days_late(bronze):
    out = silver.orders(
        bronze("orders", order("1", delivered="2017-03-05 00:00:00", due="2017-03-05 12:00:00"))
    )
    assert rows(out, "days_late", "is_late") == [(0, 0)]


def test_late_by_seconds_is_late(bronze):
    out = silver.orders(
        bronze("orders", order("1", delivered="2017-03-05 12:00:01", due="2017-03-05 12:00:00"))
    )
    assert rows(out, "days_late", "is_late") == [(0, 1)]


def test_late_needs_an_estimate(bronze):
    out = silver.orders(bronze("orders", order("1", delivered="2017-03-05")))
    assert rows(out, "days_late", "is_late", "is_delivered") == [(None, 0, 1)]


def test_day_counts_do_not_depend_on_the_session_zone(spark, bronze):
    df = bronze("orders", order("1", bought="2017-10-14 12:00:00", delivered="2017-10-15 12:00:00"))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")  # clocks moved that night
        assert rows(silver.orders(df), "delivery_days") == [(1,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_review_scores_parse_and_flag(bronze):
    texts = ["5", " 4 ", "ótimo", None, "0", "6", "3.5", "2.5", "NaN"]
    out = silver.order_reviews(
        bronze(
            "order_reviews",
            *[{"review_id": str(i), "review_score": t} for i, t in enumerate(texts)],
        )
    )
    assert "review_score_clean" not in out.columns
    assert rows(out, "review_id", "review_score", "review_score_valid") == [
        ("0", 5, 1),
        ("1", 4, 1),
        ("2", None, 0),
        ("3", None, 0),
        ("4", 0, 0),
        ("5", 6, 0),
        ("6", 4, 1),
        ("7", 2, 1),
        ("8", None, 0),
    ]


def test_payment_types(bronze):
    kinds = ["boleto", "credit_card", "voucher", "debit_card", "not_defined", "Boleto", None]
    out = silver.order_payments(
        bronze("order_payments", *[{"order_id": str(i), "payment_type": k} for i, k in enumerate(kinds)])
    )
    assert [r[1] for r in rows(out, "order_id", "payment_type_valid")] == [1, 1, 1, 1, 0, 0, 0]


def test_money_is_decimal_in_silver(bronze):
    items = silver.order_items(bronze("order_items", {"order_id": "1", "price": Decimal("1.10")}))
    paid = silver.order_payments(bronze("order_payments", {"payment_value": Decimal("1.10")}))
    assert items.schema["price"].dataType.simpleString() == "decimal(10,2)"
    assert items.schema["freight_value"].dataType.simpleString() == "decimal(10,2)"
    assert paid.schema["payment_value"].dataType.simpleString() == "decimal(10,2)"


def test_states_are_upper_case_and_zip_presence_is_flagged(bronze):
    out = silver.customers(
        bronze(
            "customers",
            {"customer_id": "1", "customer_state": "sp", "customer_zip_code_prefix": 1},
            {"customer_id": "2"},
        )
    )
    assert rows(out, "customer_id", "customer_state", "has_zip") == [("1", "SP", True), ("2", None, False)]
    sellers = silver.sellers(bronze("sellers", {"seller_id": "s", "seller_state": "rj"}))
    assert rows(sellers, "seller_state") == [("RJ",)]


def test_category_translation_leaves_nulls(bronze):
    products = bronze(
        "products",
        {"product_id": "a", "product_category_name": "livros"},
        {"product_id": "b", "product_category_name": "sem par"},
        {"product_id": "c"},
    )
    names = bronze(
        "product_category_translation",
        {"product_category_name": "livros", "product_category_name_english": "books"},
    )
    out = silver.products(products, names)
    assert rows(out, "product_id", "product_category_english") == [("a", "books"), ("b", None), ("c", None)]
    assert "product_name_length" in silver.corrected_spelling(out).columns


def test_whole_number_casts_round_half_to_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,), (2.51,)], "x double")
    assert [r[0] for r in df.select(to_long(F.col("x"))).collect()] == [0, 2, 2, 0, 3]


def test_geolocation_is_one_row_per_place(bronze):
    place = {"geolocation_zip_code_prefix": 7, "geolocation_city": "x", "geolocation_state": "SP"}
    out = silver.geolocation(
        bronze(
            "geolocation",
            {**place, "geolocation_lat": 1.0, "geolocation_lng": 4.0},
            {**place, "geolocation_lat": 3.0, "geolocation_lng": 8.0},
            {**place, "geolocation_city": "y", "geolocation_lat": 9.0},
        )
    )
    assert rows(out, "geolocation_city", "geolocation_lat", "geolocation_lng") == [
        ("x", 2.0, 6.0),
        ("y", 9.0, None),
    ]


def test_timestamps_stay_typed(bronze):
    out = silver.orders(bronze("orders", order("1")))
    assert out.schema["order_purchase_timestamp"].dataType.simpleString() == "timestamp_ntz"
    assert rows(out, "order_purchase_timestamp") == [(ts("2017-03-01"),)]
