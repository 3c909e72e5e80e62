from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from parcelscope.operators.periods import same_days_last_year, trailing_months
from parcelscope.plans import analyses
from parcelscope.plans.calendar import calendar
from parcelscope.plans.measures import margins, Context, Role, evaluate, implicit_sum
from parcelscope.schemas import GOLD


def line(order, item=1, customer="u1", seller="s1", product="p1", day=20170301, delivered=None,
         paid=None, score=None, late=0, days=None, days_late=None, price="1.00"):
    return {
        "order_id": order, "order_item_id": item, "customer_key": customer, "seller_key": seller,
        "product_key": product, "order_date_key": day, "delivery_date_key": delivered,
        "payment_value": None if paid is None else Decimal(paid), "review_score": score,
        "is_late": late, "is_delivered": 0 if delivered is None else 1, "delivery_days": days,
        "days_late": days_late, "price": Decimal(price), "freight_value": Decimal("1.00"),
    }


@pytest.fixture
def star(spark):
    def build(*lines):
        schema = GOLD["fact_orders"]
        fact = spark.createDataFrame(
            [tuple(x.get(n) for n in schema.fieldNames()) for x in lines], schema
        )
        return {
            "fact_orders": fact,
            "dim_customers": spark.createDataFrame(
                [("u1", "SP"), ("u2", "RJ"), ("u3", None)], "customer_key string, customer_state string"
            ),
            "dim_sellers": spark.createDataFrame(
                [("s1", "id1", "SP"), ("s2", "id2", "RJ")],
                "seller_key string, seller_id string, seller_state string",
            ),
            "dim_products": spark.createDataFrame(
                [("p1", "books"), ("p2", None)], "product_key string, product_category_english string"
            ),
            "dim_date": calendar(spark, date(2016, 1, 1), date(2018, 12, 31), date(2018, 12, 31)),
        }

    return build


def test_revenue_takes_each_order_once(star):
    model = star(
        line("o1", 1, paid="30.00"), line("o1", 2, paid="30.00"), line("o1", 3, paid="30.00"),
        line("o2", 1, paid="5.00"),
    )
    got = evaluate(model, ["total_revenue", "total_orders", "avg_order_value"])
    assert rows(got) == [(Decimal("35.00"), 2, 17.5)]


def test_revenue_by_seller_does_not_add_up(star):
    model = star(line("o1", 1, paid="30.00"), line("o1", 2, paid="30.00", seller="s2"))
    assert rows(evaluate(model, ["total_revenue"], by=["dim_sellers.seller_id"])) == [
        ("id1", Decimal("30.00")),
        ("id2", Decimal("30.00")),
    ]
    assert rows(evaluate(model, ["total_revenue"])) == [(Decimal("30.00"),)]


def test_on_time_counts_item_rows_and_undelivered_rows(star):
    model = star(
        line("o1", 1, late=1, delivered=20170310), line("o1", 2, late=1, delivered=20170310),
        line("o2", 1, late=0, delivered=20170310), line("o3", 1, late=0), line("o4", 1, late=None),
    )
    got = evaluate(
        model, ["on_time_rate", "seller_sla", "on_time_rate_delivered", "late_orders", "total_orders"]
    )
    assert rows(got) == [(3 / 5, 3 / 5, 1 / 3, 2, 4)]


def test_counts_over_nothing_are_blank(star):
    model = star(line("o1", late=1, delivered=20170310))
    got = evaluate(model, ["on_time_rate", "avg_review_score", "avg_days_late", "total_revenue"])
    assert rows(got) == [(None, None, None, None)]
    on_time = star(line("o1"))
    assert rows(evaluate(on_time, ["late_orders"])) == [(None,)]


def test_averages_skip_nulls(star):
    model = star(
        line("o1", days=4, late=1, days_late=2, score=5), line("o2", days=None),
        line("o3", days=8, days_late=-3, score=2),
    )
    got = evaluate(model, ["avg_delivery_days", "avg_days_late", "avg_review_score"])
    assert rows(got) == [(6.0, 2.0, 3.5)]


def test_repeat_rate_by_rows_and_by_orders(star):
    model = star(
        line("o1", 1), line("o1", 2),  # one order of two items
        line("o2", 1, customer="u2"), line("o3", 1, customer="u2"),
        line("o4", 1, customer="u3"),
    )
    got = evaluate(model, ["repeat_customer_rate", "repeat_customer_rate_orders", "total_customers"])
    assert rows(got) == [(2 / 3, 1 / 3, 3)]


def test_sketched_counts_are_close(star):
    model = star(*[line(f"o{i % 900}", i, customer=f"u{i % 200}") for i in range(2000)])
    got = evaluate(
        model, ["total_orders_approx", "total_customers_approx", "total_orders", "total_customers"]
    ).first()
    assert (got["total_orders"], got["total_customers"]) == (900, 200)
    assert abs(got["total_orders_approx"] - 900) <= 45
    assert abs(got["total_customers_approx"] - 200) <= 10


def test_clv_averages_customers_with_revenue(star):
    model = star(
        line("o1", 1, paid="10.00"), line("o1", 2, paid="10.00"), line("o2", 1, paid="20.00"),
        line("o3", 1, customer="u2", paid="6.00"), line("o4", 1, customer="u3"),
    )
    assert rows(evaluate(model, ["clv", "total_customers"])) == [(18.0, 3)]


def test_customer_measures_on_their_own_key(star):
    model = star(line("o1", paid="10.00"), line("o2", customer="u2", paid="6.00"))
    got = evaluate(model, ["clv", "total_orders"], by=["dim_customers.customer_key"])
    assert rows(got) == [("u1", 10.0, 1), ("u2", 6.0, 1)]


def test_unmatched_keys_fall_to_the_null_member(star):
    model = star(line("o1", customer="nobody", paid="1.00"), line("o2", customer="u3", paid="2.00"))
    assert rows(evaluate(model, ["total_revenue"], by=["dim_customers.customer_state"])) == [
        (None, Decimal("3.00"))
    ]


def test_families_merge_on_null_axes(star):
    model = star(line("o1", customer="u3", paid="4.00", delivered=20180101))
    got = evaluate(
        model, ["total_revenue", "clv", "orders_delivered"], by=["dim_customers.customer_state"]
    )
    assert rows(got) == [(None, Decimal("4.00"), 4.0, 1)]


def test_orders_delivered_moves_to_the_delivery_year(star):
    model = star(
        line("o1", day=20161230, delivered=20170102), line("o2", day=20170105, delivered=20170110),
        line("o3", day=20170105),
    )
    got = evaluate(model, ["orders_delivered", "total_orders"], by=["dim_date.year"])
    assert rows(got) == [(2016, None, 1), (2017, 2, 2)]


def test_yoy_without_prior_year_is_the_full_revenue(star):
    model = star(
        line("o1", day=20160310, paid="10.00"), line("o2", day=20170315, paid="25.00"),
        line("o3", day=20170401, paid="7.00"),
    )
    got = evaluate(
        model, ["total_revenue", "yoy_revenue", "yoy_revenue_pct"], by=["dim_date.year", "dim_date.month"]
    )
    assert rows(got) == [
        (2016, 3, Decimal("10.00"), Decimal("10.00"), None),
        (2017, 3, Decimal("25.00"), Decimal("15.00"), 1.5),
        (2017, 4, Decimal("7.00"), Decimal("7.00"), None),
        (2018, 3, None, Decimal("-25.00"), -1.0),
        (2018, 4, None, Decimal("-7.00"), -1.0),
    ]


def test_yoy_by_year_and_state_keeps_other_axes(star):
    model = star(
        line("o1", day=20160310, paid="10.00"),
        line("o2", day=20170315, paid="25.00", customer="u2"),
        line("o3", day=20170315, paid="4.00"),
    )
    got = evaluate(model, ["yoy_revenue"], by=["dim_date.year", "dim_customers.customer_state"],
                   where={"dim_date.year": 2017})
    assert rows(got) == [(2017, "RJ", Decimal("25.00")), (2017, "SP", Decimal("-6.00"))]


def test_complete_february_compares_with_a_leap_february(star):
    model = star(line("o1", day=20160229, paid="8.00"), line("o2", day=20170228, paid="9.00"))
    month = evaluate(model, ["yoy_revenue"], by=["dim_date.year", "dim_date.month"],
                     where={"dim_date.year": 2017})
    assert rows(month) == [(2017, 2, Decimal("1.00"))]
    day = evaluate(model, ["yoy_revenue"], by=["dim_date.date_key"], where={"dim_date.date_key": 20170228})
    assert rows(day) == [(20170228, Decimal("9.00"))]


def test_leap_day_looks_back_to_the_28th(spark):
    days = calendar(spark, date(2015, 1, 1), date(2017, 12, 31), date(2018, 1, 1))
    group = days.where("date_key IN (20160228, 20160229)").withColumn("g", F.lit(1))
    assert rows(same_days_last_year(group, days, ["g"]), "date_key") == [(20150228,)]


def test_rolling_score_is_over_rows_of_three_months(star):
    model = star(
        line("o1", day=20170115, score=1), line("o2", day=20170210, score=5),
        line("o3", day=20170211, score=5), line("o4", day=20170331, score=3),
        line("o5", day=20170430, score=None),
    )
    got = evaluate(model, ["review_score_rolling_3m"], by=["dim_date.year", "dim_date.month"])
    assert rows(got) == [
        (2017, 1, 1.0),
        (2017, 2, 11 / 3),
        (2017, 3, 14 / 4),
        (2017, 4, 13 / 3),
        (2017, 5, 3.0),
        (2017, 6, None),  # only the unscored row of April
    ]


def test_rolling_score_up_to_a_day_ignores_other_date_filters(star):
    model = star(
        line("o1", day=20170115, score=1), line("o2", day=20170116, score=2),
        line("o3", day=20170415, score=4), line("o4", day=20170416, score=5),
    )
    got = evaluate(
        model, ["review_score_rolling_3m"],
        where={"dim_date.date_key": lambda c: c.between(20170401, 20170415)},
    )
    assert rows(got) == [(3.0,)]  # 16 January to 15 April


def test_rolling_without_a_date_axis_ends_on_the_last_calendar_day(star):
    model = star(line("o1", day=20181001, score=2), line("o2", day=20180930, score=5))
    got = evaluate(model, ["review_score_rolling_3m"], by=["dim_customers.customer_state"])
    assert rows(got) == [("SP", 2.0)]


def test_trailing_months_ends_of_month(spark):
    """Windows of a group with something on every day, whatever the lengths of their months."""
    days = calendar(spark, date(2015, 1, 1), date(2017, 12, 31), date(2018, 1, 1)).select(
        F.col("full_date").alias("day"), F.lit(1).alias("n"), F.unix_date("full_date").alias("sum")
    )
    ends = days.select(F.col("day").alias("last"), F.date_format("day", "yyyy-MM-dd").alias("end"))
    got = {r["end"]: r for r in trailing_months(days, [], "day", ["n", "sum"], ends, 3).collect()}
    for end, first in [
        ("2017-02-28", "2016-12-01"), ("2016-02-29", "2015-12-01"), ("2017-05-30", "2017-02-28"), ("2017-05-31", "2017-03-01"),
        ("2016-05-28", "2016-02-29"), ("2017-04-30", "2017-02-01"), ("2015-01-20", "2015-01-01"), ("2015-03-31", "2015-01-01"),
    ]:
        a, b = date.fromisoformat(first), date.fromisoformat(end)
        numbers = [(a - date(1970, 1, 1)).days + i for i in range((b - a).days + 1)]
        assert (got[end]["n"], got[end]["sum"]) == (len(numbers), sum(numbers)), end


def test_trailing_months_of_sparse_groups(spark):
    given = [("a", "2016-01-31", 1), ("a", "2016-03-01", 2), ("a", "2017-01-01", None), ("b", "2016-03-01", 5), (None, "2016-03-02", 7)]
    daily = spark.createDataFrame([(g, date.fromisoformat(d), n) for g, d, n in given], "g string, day date, n int")
    last = ["2016-01-30", "2016-04-29", "2016-04-30", "2016-05-31", "2016-06-02", "2016-12-31", "2017-01-01", "2017-03-31", "2017-04-01"]
    ends = spark.createDataFrame([(date.fromisoformat(d), d) for d in last], "last date, name string")
    got = trailing_months(daily, ["g"], "day", ["n"], ends, 3)
    assert rows(got, "g", "name", "n") == [
        ("a", "2016-04-29", 3), ("a", "2016-04-30", 2), ("a", "2016-05-31", 2), ("a", "2017-01-01", 0),
        ("a", "2017-03-31", 0), ("b", "2016-04-29", 5), ("b", "2016-04-30", 5), ("b", "2016-05-31", 5),
        (None, "2016-04-29", 7), (None, "2016-04-30", 7), (None, "2016-05-31", 7),
    ]


def test_rolling_by_day_multiplies_no_rows(star, spark):
    model = star(line("o1", day=20170115, score=2), line("o2", day=20170415, score=4), line("o3", day=20170416, score=None))
    got = evaluate(model, ["review_score_rolling_3m"], by=["dim_date.full_date", "dim_customers.customer_state"])
    scores = {str(r["full_date"]): r["review_score_rolling_3m"] for r in got.collect()}
    assert scores["2017-01-15"] == 2.0 and scores["2017-04-14"] == 2.0 and scores["2017-04-15"] == 4.0
    assert min(scores) == "2017-01-15" and max(scores) == "2017-07-15" and scores["2017-07-15"] is None
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # the joins are the state, and the calendar once for the days there are and once for the days asked for
    assert plan.count("Join ") == 3 and plan.count("Generate explode(sequence(_day") == 1


def test_margins_equal_single_contexts(star):
    model = star(
        line("o1", paid="10.00", score=5), line("o1", paid="10.00", product="p2", score=5),
        line("o2", paid="4.00", day=20180101, late=1), line("o3", paid="1.00", customer="u2", day=20180102),
        line("o4", paid=None, customer="u2", seller="s2", product="unknown"), line("o5", paid="2.00", customer="nobody"),
    )
    measures = ["total_revenue", "total_orders", "total_customers", "on_time_rate", "avg_review_score",
                "repeat_customer_rate", "repeat_customer_rate_orders", "clv", "late_orders"]
    year, state, category = "dim_date.year", "dim_customers.customer_state", "dim_products.product_category_english"
    sets = [[year], [state], [category], [state, year], [category, state, year], []]
    got = margins(model, measures, sets)
    assert got.columns == ["year", "customer_state", "product_category_english", "margin", *measures]
    for axes in sets:
        names = [a.split(".")[1] for a in axes]
        one = evaluate(model, measures, axes)
        assert rows(got.where(F.col("margin") == ", ".join(names)), *names, *measures) == rows(one, *names, *measures)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("payment_value") and plan.count("Expand") == 1
    filtered = margins(model, ["total_revenue"], [[year], []], {state: "SP"}, Role.seller("SP"))
    assert rows(filtered.where("margin = ''"), "total_revenue") == rows(
        evaluate(model, ["total_revenue"], where={state: "SP"}, role=Role.seller("SP"))
    )
    with pytest.raises(KeyError):
        margins(model, ["yoy_revenue"], [[year]])
    with pytest.raises(ValueError):
        margins(model, ["total_orders"], [["fact_orders.order_id"]])


def test_roles_filter_the_fact_one_way(star):
    model = star(
        line("o1", paid="10.00"), line("o2", paid="5.00", seller="s2"),
        line("o3", paid="2.00", customer="u2"),
    )
    by = ["dim_customers.customer_state"]
    assert rows(evaluate(model, ["total_revenue"], by, role=Role.seller("SP"))) == [
        ("RJ", Decimal("2.00")), ("SP", Decimal("10.00"))
    ]
    assert rows(evaluate(model, ["total_revenue"], by, role=Role.region("SP"))) == [
        ("SP", Decimal("15.00"))
    ]
    assert rows(evaluate(model, ["total_revenue", "clv"], by, role=Role.region("XX"))) == []
    assert rows(evaluate(model, ["yoy_revenue"], ["dim_date.year"], role=Role.seller("RJ"))) == [
        (2017, Decimal("5.00")), (2018, Decimal("-5.00"))
    ]


def test_filters_on_fact_and_dimensions(star):
    model = star(
        line("o1", paid="10.00", delivered=20170310), line("o2", paid="5.00", day=20160101),
        line("o3", paid="2.00", customer="u2", delivered=20170310),
    )
    where = {"fact_orders.is_delivered": 1, "dim_date.year": [2017, 2018],
             "dim_customers.customer_state": lambda c: c != "RJ"}
    assert rows(evaluate(model, ["total_revenue"], where=where)) == [(Decimal("10.00"),)]


def test_only_summable_columns_are_summed(star):
    model = star(line("o1", 1, price="2.50", paid="9.00"), line("o1", 2, price="3.00", paid="9.00"))
    assert rows(evaluate(model, [implicit_sum("price")])) == [(Decimal("5.50"),)]
    for column in ("payment_value", "order_date_key", "delivery_date_key"):
        with pytest.raises(ValueError):
            implicit_sum(column)


def test_bad_names_are_refused(star):
    model = star(line("o1"))
    with pytest.raises(KeyError):
        evaluate(model, ["nonsense"])
    with pytest.raises(ValueError):
        evaluate(model, ["total_orders"], by=["year"])
    with pytest.raises(ValueError):
        Context.of(by=["dim_sellers.state", "dim_customers.state"])


def test_yoy_equals_a_day_by_day_count(spark, star):
    """Brute force over random-looking days, at day grain."""
    start = date(2016, 1, 1)
    lines, paid = [], {}
    for i in range(300):
        day = start + timedelta(days=(i * 37) % 1000)
        value = Decimal(i % 17 + 1)
        lines.append(line(f"o{i}", day=int(day.strftime("%Y%m%d")), paid=f"{value}.00"))
        paid[day] = paid.get(day, 0) + value
    got = {
        r["full_date"]: r["yoy_revenue"]
        for r in evaluate(star(*lines), ["yoy_revenue"], by=["dim_date.full_date"]).collect()
    }

    def back(d):
        return d.replace(year=d.year - 1, day=28) if (d.month, d.day) == (2, 29) else d.replace(year=d.year - 1)

    day, want = start, {}
    while day <= date(2018, 12, 31):
        now = paid.get(day)
        before = paid.get(back(day)) if back(day) >= start else None
        if now is not None or before is not None:
            want[day] = (now or 0) - (before or 0)
        day += timedelta(days=1)
    assert got == want


def test_concentration_shares(star):
    model = star(
        *[line(f"a{i}", late=1) for i in range(3)], line("b", seller="s2", late=1),
        line("c", seller="s3"), line("d", seller="s4", late=1),
    )
    assert rows(analyses.seller_concentration(model["fact_orders"])) == [
        (0, 1, 1.0, 1.0), (1, 2, 3 / 4, 1.0), (3, 1, 1 / 4, 3 / 5),
    ]


def test_lag_and_score(star):
    model = star(
        line("a", days_late=-10, score=5), line("b", days_late=0, score=4),
        line("c", days_late=10, score=3), line("d", days_late=3), line("e", score=1),
    )
    got = {r["band"]: r for r in analyses.lag_vs_score(model["fact_orders"]).collect()}
    assert set(got) == {"early by more than 7", "on the day", "late by more than 7", "all"}
    assert got["all"]["lag_score_corr"] == pytest.approx(-1.0)
    assert got["on the day"]["lag_score_corr"] is None
