"""The semantic model: measures over any dimension axes, under filters and a security role.

``evaluate`` answers a set of measures for one filter context. Measures are grouped into families
that share an aggregation; each family is one pass over the fact table, and the small per-axis
results are put side by side at the end.

Grain: the fact table has one row per order item. ``late_orders``, ``on_time_rate`` and
``seller_sla`` count item rows, and ``repeat_customer_rate`` counts item rows per customer; the
variants ending in ``_delivered`` and ``_orders`` use delivered rows and distinct orders.
Revenue takes each order's payment once per group, so over axes that split an order (product,
seller) the groups do not add up to the total. No measure is rolled up from a finer axis.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelscope.functions.ratios import blank_if_zero, ratio
from parcelscope.operators.joins import hot_keys
from parcelscope.operators.periods import same_days_last_year, trailing_months
from parcelscope.plans.gold import Gold
from parcelscope.plans.refresh import MONTH, month_of
from parcelscope.schemas import GOLD

FACT = "fact_orders"
DATES = "dim_date"

# fact column -> dimension key
RELATIONSHIPS = {
    "dim_customers": ("customer_key", "customer_key"),
    "dim_sellers": ("seller_key", "seller_key"),
    "dim_products": ("product_key", "product_key"),
    DATES: ("order_date_key", "date_key"),
}
DELIVERY_RELATIONSHIP = ("delivery_date_key", "date_key")

# fact columns that may be summed as they are; payment_value repeats on every item of its order
# and date keys are not quantities
SUMMABLE = (
    "price",
    "freight_value",
    "review_score",
    "delivery_days",
    "days_late",
    "is_late",
    "is_delivered",
)


@dataclass(frozen=True)
class Axis:
    """One grouping column, written ``table.column``."""

    table: str
    column: str

    @classmethod
    def of(cls, name: str) -> Axis:
        table, _, column = name.partition(".")
        if not column:
            raise ValueError(f"axis {name!r} must be written table.column")
        return cls(table, column)


@dataclass(frozen=True)
class Role:
    """A security role: the principal sees only dimension rows whose column holds its value.

    The filter flows from the dimension to the fact, not to the other dimensions.
    """

    table: str
    column: str
    principal: str

    @classmethod
    def seller(cls, state: str) -> Role:
        return cls("dim_sellers", "seller_state", state)

    @classmethod
    def region(cls, state: str) -> Role:
        return cls("dim_customers", "customer_state", state)


@dataclass(frozen=True)
class Context:
    """Axes, filters and role. A filter value is one value, a list, or a Column -> Column test."""

    by: tuple[Axis, ...] = ()
    where: tuple[tuple[Axis, Any], ...] = ()
    role: Role | None = None

    @classmethod
    def of(
        cls,
        by: Sequence[str] = (),
        where: Mapping[str, Any] | None = None,
        role: Role | None = None,
    ) -> Context:
        axes = tuple(Axis.of(b) for b in by)
        if len({a.column for a in axes}) != len(axes):
            raise ValueError("axis columns must have distinct names")
        return cls(axes, tuple((Axis.of(k), v) for k, v in (where or {}).items()), role)

    @property
    def names(self) -> list[str]:
        return [a.column for a in self.by]

    def axes_of(self, table: str) -> list[str]:
        return [a.column for a in self.by if a.table == table]

    def without_dates(self) -> Context:
        """Date intelligence replaces the date filters and keeps all others."""
        return Context(
            tuple(a for a in self.by if a.table != DATES),
            tuple((a, v) for a, v in self.where if a.table != DATES),
            self.role,
        )

    def filters(self, table: str) -> list[Column]:
        tests = [_test(F.col(a.column), v) for a, v in self.where if a.table == table]
        if self.role is not None and self.role.table == table:
            tests.append(F.col(self.role.column) == self.role.principal)
        return tests


def _test(column: Column, wanted: Any) -> Column:
    if callable(wanted):
        return wanted(column)
    if isinstance(wanted, (list, tuple, set, frozenset)):
        return column.isin(*wanted)
    return column == wanted


def _all(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests)


def in_context(
    model: Mapping[str, DataFrame],
    context: Context,
    columns: Sequence[str],
    date_relationship: tuple[str, str] = RELATIONSHIPS[DATES],
) -> DataFrame:
    """Fact rows visible in the context, with their axis columns and the fact ``columns``.

    Only dimensions that carry an axis or a filter are joined: a filtered dimension restricts the
    fact (semi join when no axis is read from it), an unfiltered one adds its columns and leaves
    them null for fact rows without a match.
    """
    relationships = {**RELATIONSHIPS, DATES: date_relationship}
    rows = model[FACT]
    tests = context.filters(FACT)
    if tests:
        rows = rows.where(_all(tests))
    for table, (fact_key, dim_key) in relationships.items():
        axes = context.axes_of(table)
        tests = context.filters(table)
        if not axes and not tests:
            continue
        dim = model[table]
        if tests:
            dim = dim.where(_all(tests))
        same = F.col(fact_key) == F.col("_key")
        month = []
        if table == DATES and tests and fact_key == RELATIONSHIPS[DATES][0] and MONTH in rows.columns:
            # a fact stored by month: the days left by the filters also pick the files to read
            month = [month_of(F.col(dim_key)).alias("_month")]
            same &= F.col(MONTH) == F.col("_month")
        dim = dim.select(
            F.col(dim_key).alias("_key"), *month, *[F.col(a).alias(f"_axis_{a}") for a in axes]
        )
        if table == DATES:
            dim = F.broadcast(dim)  # one row per calendar day
        how = "left" if not tests else "inner" if axes else "left_semi"
        rows = rows.join(dim, same, how).drop("_key", "_month")
    axis_columns = [
        F.col(a.column if a.table == FACT else f"_axis_{a.column}").alias(a.column)
        for a in context.by
    ]
    kept = [c for c in columns if c not in context.names]
    return rows.select(*axis_columns, *kept)


@dataclass(frozen=True)
class Measure:
    family: str
    needs: tuple[str, ...]
    value: Callable[[], Column]


# Additive per-row totals: name -> (fact columns, aggregate)
ROW_TOTALS: dict[str, tuple[tuple[str, ...], Callable[[], Column]]] = {
    "n_rows": ((), lambda: F.count(F.lit(1))),
    "n_on_time": (("is_late",), lambda: F.count_if(F.coalesce("is_late", F.lit(0)) == 0)),
    "n_late": (("is_late",), lambda: F.count_if(F.col("is_late") == 1)),
    "n_delivered": (("is_delivered",), lambda: F.count_if(F.col("is_delivered") == 1)),
    "n_delivered_on_time": (
        ("is_delivered", "is_late"),
        lambda: F.count_if((F.col("is_delivered") == 1) & (F.col("is_late") == 0)),
    ),
    "n_days": (("delivery_days",), lambda: F.count("delivery_days")),
    "sum_days": (("delivery_days",), lambda: F.sum("delivery_days")),
    "n_days_late": (
        ("is_late", "days_late"),
        lambda: F.count(F.when(F.col("is_late") == 1, F.col("days_late"))),
    ),
    "sum_days_late": (
        ("is_late", "days_late"),
        lambda: F.sum(F.when(F.col("is_late") == 1, F.col("days_late"))),
    ),
    "n_scores": (("review_score",), lambda: F.count("review_score")),
    "sum_scores": (("review_score",), lambda: F.sum("review_score")),
    **{
        f"total_{c}": ((c,), (lambda column: lambda: F.sum(column))(c)) for c in SUMMABLE
    },
}
ORDER_TOTALS = ("revenue", "orders")


def _c(name: str) -> Column:
    return F.col(f"_{name}")


def _on_time() -> Column:
    return ratio(blank_if_zero(_c("n_on_time")), _c("n_rows"))


MEASURES: dict[str, Measure] = {
    # orders and revenue
    "total_revenue": Measure("orders", ("revenue",), lambda: _c("revenue")),
    "total_orders": Measure("orders", ("orders",), lambda: blank_if_zero(_c("orders"))),
    "avg_order_value": Measure(
        "orders", ("revenue", "orders"), lambda: ratio(_c("revenue"), _c("orders"))
    ),
    # delivery
    "on_time_rate": Measure("orders", ("n_on_time", "n_rows"), _on_time),
    "seller_sla": Measure("orders", ("n_on_time", "n_rows"), _on_time),
    "on_time_rate_delivered": Measure(
        "orders",
        ("n_delivered_on_time", "n_delivered"),
        lambda: ratio(blank_if_zero(_c("n_delivered_on_time")), _c("n_delivered")),
    ),
    "late_orders": Measure("orders", ("n_late",), lambda: blank_if_zero(_c("n_late"))),
    "avg_delivery_days": Measure(
        "orders", ("sum_days", "n_days"), lambda: ratio(_c("sum_days"), _c("n_days"))
    ),
    "avg_days_late": Measure(
        "orders",
        ("sum_days_late", "n_days_late"),
        lambda: ratio(_c("sum_days_late"), _c("n_days_late")),
    ),
    "orders_delivered": Measure(
        "delivered", ("orders",), lambda: blank_if_zero(_c("orders"))
    ),
    # quality
    "avg_review_score": Measure(
        "orders", ("sum_scores", "n_scores"), lambda: ratio(_c("sum_scores"), _c("n_scores"))
    ),
    "review_score_rolling_3m": Measure(
        "rolling", ("sum_scores", "n_scores"), lambda: ratio(_c("sum_scores"), _c("n_scores"))
    ),
    # customers
    "total_customers": Measure("customers", (), lambda: blank_if_zero(_c("customers"))),
    "repeat_customer_rate": Measure(
        "customers", (), lambda: ratio(blank_if_zero(_c("repeat_rows")), _c("customers"))
    ),
    "repeat_customer_rate_orders": Measure(
        "customers",
        ("by_order",),
        lambda: ratio(blank_if_zero(_c("repeat_orders")), _c("customers")),
    ),
    "clv": Measure("customers", ("by_order",), lambda: ratio(_c("ltv"), _c("n_ltv"))),
    # the same counts from sketches: one pass without an order or customer grain
    "total_orders_approx": Measure(
        "sketches", ("order_id",), lambda: blank_if_zero(_c("order_id"))
    ),
    "total_customers_approx": Measure(
        "sketches", ("customer_key",), lambda: blank_if_zero(_c("customer_key"))
    ),
    # year over year: a missing side counts as nothing in the difference, but not in the quotient
    "yoy_revenue": Measure(
        "yoy",
        (),
        lambda: F.when(
            F.coalesce(_c("current"), _c("prior")).isNotNull(),
            F.coalesce(_c("current"), F.lit(0)) - F.coalesce(_c("prior"), F.lit(0)),
        ),
    ),
    "yoy_revenue_pct": Measure(
        "yoy",
        (),
        lambda: ratio(F.coalesce(_c("current"), F.lit(0)) - _c("prior"), _c("prior")),
    ),
    # plain column sums
    **{
        f"sum_{c}": Measure(
            "orders", (f"total_{c}",), (lambda column: lambda: _c(f"total_{column}"))(c)
        )
        for c in SUMMABLE
    },
}


def implicit_sum(column: str) -> str:
    """The name of the measure that sums a fact column; refuses columns that must not be summed."""
    if column not in SUMMABLE:
        raise ValueError(f"{column} cannot be summed over item rows")
    return f"sum_{column}"


def _keys(names: list[str], *more: str) -> list[str]:
    """Grouping keys without repeats, for axes that are themselves keys."""
    return list(dict.fromkeys([*names, *more]))


def _order_totals(rows: DataFrame, names: list[str], needs: list[str]) -> DataFrame:
    """Per-axis totals. Rows are reduced to orders first when an order-level total is wanted."""
    row_level = [n for n in needs if n in ROW_TOTALS]
    totals = [ROW_TOTALS[n][1]().alias(f"_{n}") for n in row_level]
    if not any(n in ORDER_TOTALS for n in needs):
        return rows.groupBy(*names).agg(*totals)
    if "revenue" in needs:
        totals.append(F.max("payment_value").alias("_payment"))
    keys = _keys(names, "order_id")
    orders = rows.groupBy(*keys).agg(*totals) if totals else rows.select(*keys).distinct()
    sums = [F.sum(f"_{n}").alias(f"_{n}") for n in row_level]
    if "revenue" in needs:
        sums.append(F.sum("_payment").alias("_revenue"))
    return orders.groupBy(*names).agg(*sums, F.count("order_id").alias("_orders"))


def _orders(model, context, needs, date_relationship=RELATIONSHIPS[DATES]) -> DataFrame:
    columns = {c for n in needs if n in ROW_TOTALS for c in ROW_TOTALS[n][0]}
    if "revenue" in needs:
        columns.add("payment_value")
    if any(n in ORDER_TOTALS for n in needs):
        columns.add("order_id")
    rows = in_context(model, context, sorted(columns), date_relationship)
    return _order_totals(rows, context.names, needs)


def _delivered(model, context, needs) -> DataFrame:
    """Orders by delivery date: the other date relationship, undelivered rows left out."""
    delivered = Context(
        context.by,
        (*context.where, (Axis(FACT, "delivery_date_key"), lambda c: c.isNotNull())),
        context.role,
    )
    return _orders(model, delivered, needs, DELIVERY_RELATIONSHIP)


def _customers(model, context, needs) -> DataFrame:
    names = context.names
    by_order = "by_order" in needs
    columns = ["customer_key", *(["order_id", "payment_value"] if by_order else [])]
    rows = in_context(model, context, columns)
    one = F.count(F.lit(1))
    if by_order:
        orders = rows.groupBy(*_keys(names, "customer_key", "order_id")).agg(
            F.max("payment_value").alias("_payment"), one.alias("_n_rows")
        )
        people = orders.groupBy(*_keys(names, "customer_key")).agg(
            F.sum("_payment").alias("_ltv"),
            F.sum("_n_rows").alias("_n_rows"),
            one.alias("_n_orders"),
        )
        extra = [
            F.sum("_ltv").alias("_ltv"),
            F.count("_ltv").alias("_n_ltv"),
            F.count_if(F.col("_n_orders") >= 2).alias("_repeat_orders"),
        ]
    else:
        people = rows.groupBy(*_keys(names, "customer_key")).agg(one.alias("_n_rows"))
        extra = []
    return people.groupBy(*names).agg(
        F.count("customer_key").alias("_customers"),
        F.count_if(F.col("_n_rows") >= 2).alias("_repeat_rows"),
        *extra,
    )


def _sketches(model, context, needs) -> DataFrame:
    """Distinct counts within about two percent; for axes where exact ones cost too much."""
    rows = in_context(model, context, needs)
    return rows.groupBy(*context.names).agg(
        *[F.approx_count_distinct(n, 0.02).alias(f"_{n}") for n in needs]
    )


def _days_in_context(model, context) -> tuple[DataFrame, list[str]]:
    """Calendar days left by the date filters, under the names of the date axes."""
    axes = context.axes_of(DATES)
    tests = context.filters(DATES)
    days = model[DATES].where(_all(tests)) if tests else model[DATES]
    renamed = [F.col(a).alias(f"_axis_{a}") for a in axes]
    return days.select("full_date", "date_key", *renamed), [f"_axis_{a}" for a in axes]


def _period_names(context, group) -> list[Column]:
    return [
        F.col(f"_axis_{a.column}").alias(a.column) if a.table == DATES else F.col(a.column)
        for a in context.by
    ]


def _rolling(model, context, needs) -> DataFrame:
    """Scores of the three months up to each group's last calendar day.

    The fact is reduced to one row per day and remaining axis; the work after that depends on the
    calendar only.
    """
    days, group = _days_in_context(model, context)
    ends = days.groupBy(*group).agg(F.max("full_date").alias("last")).where(F.col("last").isNotNull())
    other = context.without_dates()
    rows = in_context(model, other, ["order_date_key", "review_score"])
    # axes that are the key itself stay under their own name
    daily = rows.groupBy(*_keys(other.names, "order_date_key")).agg(
        *[ROW_TOTALS[n][1]().alias(f"_{n}") for n in needs]
    )
    known = model[DATES].select(F.col("date_key").alias("_key"), F.col("full_date").alias("_day"))
    dated = daily.join(F.broadcast(known), F.col("order_date_key") == F.col("_key")).drop("_key")
    windowed = trailing_months(dated, other.names, "_day", [f"_{n}" for n in needs], ends, 3)
    return windowed.select(*_period_names(context, group), *[f"_{n}" for n in needs])


def _yoy(model, context, needs) -> DataFrame:
    """Revenue of each group's days and of the same days a year earlier, in one pass."""
    days, group = _days_in_context(model, context)
    now = days.select(*group, "date_key", F.lit(False).alias("_earlier"))
    before = same_days_last_year(days, model[DATES], group).withColumn("_earlier", F.lit(True))
    periods = now.unionByName(before)
    other = context.without_dates()
    rows = in_context(model, other, ["order_date_key", "order_id", "payment_value"])
    # at most two rows per calendar day and group, and a day is in one group
    dated = rows.join(F.broadcast(periods), F.col("order_date_key") == F.col("date_key"))
    names = _period_names(context, group)
    paid = F.col("payment_value")
    keys = [*names, *([] if "order_id" in context.names else ["order_id"])]
    orders = dated.groupBy(*keys).agg(
        F.max(F.when(~F.col("_earlier"), paid)).alias("_current"),
        F.max(F.when(F.col("_earlier"), paid)).alias("_prior"),
    )
    return orders.groupBy(*context.names).agg(
        F.sum("_current").alias("_current"), F.sum("_prior").alias("_prior")
    )


FAMILIES = {
    "orders": _orders,
    "delivered": _delivered,
    "customers": _customers,
    "sketches": _sketches,
    "rolling": _rolling,
    "yoy": _yoy,
}


def evaluate(
    model: Mapping[str, DataFrame],
    measures: Sequence[str],
    by: Sequence[str] = (),
    where: Mapping[str, Any] | None = None,
    role: Role | None = None,
) -> DataFrame:
    """One row per axis value with the requested measures; a blank measure is null.

    ``model`` holds ``fact_orders`` and the four dimensions. ``by`` and the keys of ``where`` name
    columns as ``table.column``; the result names axes by column.
    """
    unknown = [m for m in measures if m not in MEASURES]
    if unknown:
        raise KeyError(f"unknown measures: {unknown}")
    context = Context.of(by, where, role)
    names = context.names
    parts = []
    for family, totals in FAMILIES.items():
        members = [m for m in measures if MEASURES[m].family == family]
        if not members:
            continue
        needs = list(dict.fromkeys(n for m in members for n in MEASURES[m].needs))
        values = [MEASURES[m].value().alias(m) for m in members]
        parts.append(totals(model, context, needs).select(*names, *values))
    if len(parts) == 1:
        return parts[0].select(*names, *measures)
    # at most one row per axis value and family; null axis values group together
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    merged = stacked.groupBy(*names).agg(*[F.max(m).alias(m) for m in measures])
    return merged.select(*names, *measures)


def _carried(model: Mapping[str, DataFrame], context: Context) -> tuple[Mapping[str, DataFrame], Context] | None:
    """The model and context with axes of customers and products as columns of the fact's rows.

    For a fact that is still to be made: its items and orders meet both on their way and need not be
    moved again by hashed keys. Its customer key is the natural id here, as the two are one to one.
    None where the context asks for more than axes of these and of the calendar, or where a customer
    has so many orders that no task should have all of them.
    """
    axes = {t: context.axes_of(t) for t in ("dim_customers", "dim_products")}
    others = {a.table for a in context.by} - {DATES, *axes}
    filtered = {a.table for a, _ in context.where} - {DATES}
    taken = {*GOLD[FACT].fieldNames(), "customer_id", "customer_unique_id", "seller_id", "product_id"}
    if not isinstance(model, Gold) or others or filtered or context.role or taken & set(context.names):
        return None
    if hot_keys(model.silver["customers"], "customer_unique_id", ["customer_id"]).limit(1).collect():
        return None
    fact = model.rows(axes).withColumnRenamed("customer_unique_id", "customer_key")
    by = tuple(Axis(FACT, a.column) if a.table in axes else a for a in context.by)
    return {FACT: fact, DATES: model[DATES]}, Context(by, context.where)


def margins(
    model: Mapping[str, DataFrame],
    measures: Sequence[str],
    sets: Sequence[Sequence[str]],
    where: Mapping[str, Any] | None = None,
    role: Role | None = None,
) -> DataFrame:
    """``evaluate`` over several sets of axes at once, the empty set being the total.

    One row per set and axis value: the axes, null where a set leaves them out, ``margin``, the names
    of the set's axes, and the measures. The fact is read once and reduced to its orders, customers
    and axes; the sets multiply only these. As an order counts once in every group it has a part in,
    each set takes maxima per order and counts customers anew, and no set is rolled up from another.

    Over a fact still to be made the rows carry their axes and are dealt by customer once; sets,
    orders and customers are then counted where the rows lie. Otherwise every step is an aggregate
    with an exchange of its own, which no single customer can make long.
    """
    odd = [m for m in measures if m not in MEASURES or MEASURES[m].family not in ("orders", "customers")]
    if odd:
        raise KeyError(f"measures that margins do not give: {odd}")
    names = list(dict.fromkeys(name for axes in sets for name in axes))
    context = Context.of(names, where, role)
    axes = context.names
    if {"customer_key", "order_id"} & set(axes):
        raise ValueError("orders and customers are what margins count, not axes")
    needs = list(dict.fromkeys(n for m in measures for n in MEASURES[m].needs if n in ROW_TOTALS))
    wanted = {"order_id", "customer_key", "payment_value", *(c for n in needs for c in ROW_TOTALS[n][0])}
    carried = _carried(model, context)
    rows = in_context(*(carried or (model, context)), sorted(wanted))
    one = F.count(F.lit(1)).alias("_rows")
    grain = rows.groupBy(*axes, "customer_key", "order_id").agg(
        F.max("payment_value").alias("_payment"), one, *[ROW_TOTALS[n][1]().alias(f"_{n}") for n in needs]
    )
    added = [F.sum(f"_{n}").alias(f"_{n}") for n in ["rows", *needs]]
    keys = [*axes, "_set"]
    chosen = [[Axis.of(a).column for a in own] for own in sets]
    bit = {a: 1 << (len(axes) + 1 - i) for i, a in enumerate(axes)}  # the two keys are the lowest bits
    left_out = [sum(bit[a] for a in axes if a not in inside) for inside in chosen]
    per_order = [F.max("_payment").alias("_payment"), *added]
    if carried:
        types = dict(grain.dtypes)
        in_set = [
            F.struct(
                F.lit(number).cast("long").alias("_set"),
                *[(F.col(a) if a in inside else F.lit(None).cast(types[a])).alias(a) for a in axes],
            )
            for inside, number in zip(chosen, left_out)
        ]
        # dealt by customer before the rows are multiplied: the aggregates below need no other exchange
        dealt = grain.repartition("customer_key").select(
            "customer_key", "order_id", "_payment", "_rows", *[f"_{n}" for n in needs], F.explode(F.array(*in_set)).alias("_in")
        )
        orders = dealt.select("*", "_in.*").groupBy(*keys, "customer_key", "order_id").agg(*per_order)
    else:
        grouped = [[F.col(a) for a in [*inside, "customer_key", "order_id"]] for inside in chosen]
        orders = grain.groupingSets(grouped, *axes, "customer_key", "order_id").agg(
            F.grouping_id().alias("_set"), *per_order
        )
    people = orders.groupBy(*keys, "customer_key").agg(
        F.sum("_payment").alias("_ltv"), F.count("order_id").alias("_orders"),
        F.count(F.lit(1)).alias("_any_orders"), *added,
    )
    totals = people.groupBy(*keys).agg(
        F.sum("_ltv").alias("_revenue"), F.sum("_orders").alias("_orders"),
        F.sum("_ltv").alias("_ltv"), F.count("_ltv").alias("_n_ltv"), F.count("customer_key").alias("_customers"),
        F.count_if(F.col("_rows") >= 2).alias("_repeat_rows"),
        F.count_if(F.col("_any_orders") >= 2).alias("_repeat_orders"),
        *[F.sum(f"_{n}").alias(f"_{n}") for n in needs],
    )
    label = F.lit(None).cast("string")
    for inside, number in zip(chosen, left_out):
        label = F.when(F.col("_set") == number, F.lit(", ".join(inside))).otherwise(label)
    return totals.select(*axes, label.alias("margin"), *[MEASURES[m].value().alias(m) for m in measures])
