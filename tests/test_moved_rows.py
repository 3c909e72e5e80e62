"""Joins that leave wide rows where they are, against the plain joins they stand for."""

from __future__ import annotations

import hashlib
from datetime import date
from decimal import Decimal
from functools import partial

import pytest
from conftest import order, rows, ts
from pyspark.sql import functions as F

from parcelscope import suite
from parcelscope.operators.joins import known_join, odd_keys
from parcelscope.plans import gold, measures
from parcelscope.plans.calendar import calendar
from parcelscope.plans.gold import Gold
from parcelscope.plans.measures import margins
from parcelscope.plans.refresh import changed_keys
from parcelscope.plans.silver import Silver


@pytest.fixture
def shop(spark, bronze):
    """Twelve orders of three people; one seller and one product come twice, one of each is unknown."""
    n = range(12)
    person = lambda i: {"customer_id": f"c{i}", "customer_unique_id": f"u{i % 3}", "customer_state": ["sp", "rj", None][i % 3]}
    tables = {
        "orders": bronze("orders", *[order(f"o{i}", f"c{i}", f"201{6 + i % 2}-03-01") for i in n]),
        "order_items": bronze("order_items", *[
            {"order_id": f"o{i}", "order_item_id": k, "seller_id": [None, "s1", "s2", "gone"][(i + k) % 4], "product_id": f"p{(i * k) % 4}"}
            for i in n for k in (1, 2, 3, 4)
        ]),
        "order_payments": bronze("order_payments", *[{"order_id": f"o{i}", "payment_sequential": 1, "payment_value": Decimal(10 + i)} for i in n]),
        "order_reviews": bronze("order_reviews", *[{"review_id": f"r{i}", "order_id": f"o{i}", "review_score": str(i % 6), "review_answer_timestamp": ts("2017-04-01")} for i in n]),
        "customers": bronze("customers", *[person(i) for i in n]),
        "sellers": bronze("sellers", {"seller_id": "s1"}, {"seller_id": "s2"}, {"seller_id": "s2"}),
        "products": bronze("products", *[{"product_id": p, "product_category_name": c} for p, c in (("p0", "a"), ("p1", "b"), ("p1", "a"), ("p2", None))]),
        "product_category_translation": bronze("product_category_translation", {"product_category_name": "a", "product_category_name_english": "A"}),
        "geolocation": bronze("geolocation"),
    }
    return Gold(Silver(tables.__getitem__), calendar(spark, date(2016, 1, 1), date(2018, 12, 31), date(2018, 12, 31)))


@pytest.mark.parametrize("most_listed", [0, 100])
@pytest.mark.parametrize("held", [["a", "b", "c"], ["a", "b", "b", "b", None], ["b", "b"], ["a", "z"], []])
def test_known_join_is_the_plain_join(spark, held, most_listed):
    many = spark.createDataFrame([(i, k) for i, k in enumerate(["a", "b", "c", None, "a", "b"])], "i int, k string")
    one = spark.createDataFrame([(k, 1) for k in held], "k string, x int")
    got = known_join(many, one, "k", many, look_bytes=0, most_listed=most_listed)
    assert sorted(got.columns) == ["i", "k"] and rows(got, "i", "k") == rows(many.join(one.select("k"), "k"), "i", "k")


def test_odd_keys_name_what_is_missing_or_repeated(spark):
    many = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    one = spark.createDataFrame([("a",), ("b",), ("b",), ("z",), ("z",), (None,)], "k string")
    assert rows(odd_keys(many, one, "k")) == [("b", 2), ("c", 0)]


def test_large_fact_does_not_move_its_rows_to_sellers_and_products(shop, spark, monkeypatch):
    """F8: wide item rows cross the network for the order alone."""
    plain = rows(shop["fact_orders"])
    monkeypatch.setattr(gold, "known_join", partial(known_join, look_bytes=0))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = gold.fact_orders(shop.silver, shop)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange hashpartitioning(seller_id" not in plan and "Exchange hashpartitioning(product_id" not in plan
    assert rows(found) == plain and len(plain) > 20


def test_margins_of_a_fact_to_be_made_move_it_once(shop, monkeypatch):
    """the same margins as over the finished tables, without rows multiplied before an exchange."""
    year, state, category = "dim_date.year", "dim_customers.customer_state", "dim_products.product_category_english"
    names = ["total_revenue", "total_orders", "total_customers", "on_time_rate", "avg_review_score",
             "repeat_customer_rate", "repeat_customer_rate_orders", "clv"]
    sets = [[year], [state], [category], [year, state], [state, category], []]
    finished = margins({t: shop[t] for t in shop}, names, sets)
    carried = margins(shop, names, sets)
    plan = carried._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "md5" not in plan
    assert rows(carried) == rows(finished) and carried.columns == finished.columns
    hot = partial(measures.hot_keys, hot_rows=1, one_in=1)
    monkeypatch.setattr(measures, "hot_keys", hot)
    assert "Expand" in margins(shop, names, sets)._jdf.queryExecution().optimizedPlan().toString()


def test_refreshed_fact_is_staged_without_hashed_keys(spark, shop, monkeypatch):
    """what is stored on the way has natural ids; the refreshed fact has all of its columns."""
    seen, stage = {}, suite.staged
    monkeypatch.setattr(suite, "staged", lambda df, label: seen.setdefault(label, df) and stage(df, label))
    monkeypatch.setattr(suite, "model_of", lambda spark, folder: shop)
    lake = suite._refreshed_gold(spark, "")
    assert not {c for c in seen["fact_orders"].columns if c.endswith("_key") and "date" not in c}
    assert rows(lake.table("gold", "fact_orders")) == rows(shop["fact_orders"])


def test_stored_tables_are_entropy_coded(spark, shop):
    """hashed keys are half as long on disk."""
    from parcelscope.settings import configure, staged

    stored = staged(configure(spark).range(3).select(F.md5(F.col("id").cast("string")).alias("k")), "keys")
    assert all(".zstd." in f for f in stored.inputFiles())


def test_same_day_loads_share_one_extract(spark, monkeypatch):
    """the three modes load one extract, which is written once."""
    written, loaded = [], []
    monkeypatch.setattr(suite, "bronze_of", lambda spark, folder: lambda table: spark.range(1))
    monkeypatch.setattr(suite, "_extract", lambda lake, df, name: written.append(name) or f"path-{len(written)}")
    monkeypatch.setattr(suite, "incremental_load", lambda lake, ledger, table, source, *a, **k: loaded.append(source))
    suite.in_same_day_load(spark, "")
    assert written == ["orders"] and loaded == ["path-1"] * 6


def test_as_of_join_reads_a_stored_fact_by_natural_id(spark, shop, monkeypatch):
    """the fact is made once, though it is looked at for hot customers and then joined."""
    versions = spark.createDataFrame(
        [("u0", "x", "SP", date(2016, 1, 1), None)],
        "customer_unique_id string, customer_city string, customer_state string, effective_start_date date, effective_end_date date",
    )
    seen, join = [], suite.as_of_join
    monkeypatch.setattr(suite, "model_of", lambda spark, folder: shop)
    monkeypatch.setattr(suite, "_customer_history", lambda spark, folder: versions)
    monkeypatch.setattr(suite, "as_of_join", lambda fact, *a: seen.append((fact, a[1])) or join(fact, *a))
    found = suite.gd_fact_asof(spark, "")
    plan = seen[0][0]._jdf.queryExecution().optimizedPlan().toString()
    assert seen[0][1] == "customer_unique_id" and "md5" not in plan and "Join" not in plan
    fact = shop["fact_orders"].withColumnRenamed("customer_key", "member_key")
    assert rows(found, "order_id", "order_item_key", "member_key", "price") == rows(
        fact, "order_id", "order_item_key", "member_key", "price"
    )
    assert rows(found.where("customer_city = 'x'").select("member_key").distinct()) == [(hashlib.md5(b"u0").hexdigest(),)]


def test_changed_keys_add_up_whole_numbers(spark):
    """sums of 64 bits instead of decimals, and the same keys found, multisets told apart."""
    before = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3), ("d", 4)], "k string, v int")
    after = spark.createDataFrame([("a", 1), ("b", 2), (None, 5), ("c", 1), ("d", 4)], "k string, v int")
    found = changed_keys(before, after, "k")
    assert "decimal" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert rows(found) == sorted([("a",), (None,), ("c",)], key=str)
