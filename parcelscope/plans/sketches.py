"""Stored, mergeable distinct counts.

Distinct orders and customers do not add up over groups, but sketches of them merge. The fact is
sketched once per order day, customer state and product category; from then on any axes over these,
calendar axes among them, are answered from the stored sketches alone. A sketch keeps few values as
they are and many with a relative error of about ``0.8 / sqrt(2 ** LOG_SIZE)``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelscope.plans.measures import DATES, Context, in_context
from parcelscope.sources.lake import Lake

LAYER, TABLE = "gold", "distinct_sketches"
LOG_SIZE = 15
GRAIN = ("fact_orders.order_date_key", "dim_customers.customer_state", "dim_products.product_category_english")
COUNTED = {"total_orders_approx": "order_id", "total_customers_approx": "customer_key"}


def sketched(model: Mapping[str, DataFrame], log_size: int = LOG_SIZE) -> DataFrame:
    """One row per day, state and category with a sketch of each counted column. Sketches are merged on
    the map side, so a popular group sends one per task."""
    context = Context.of(GRAIN)
    rows = in_context(model, context, sorted(COUNTED.values()))
    return rows.groupBy(*context.names).agg(
        *[F.hll_sketch_agg(column, F.lit(log_size)).alias(name) for name, column in COUNTED.items()]
    )


def store_sketches(lake: Lake, model: Mapping[str, DataFrame], log_size: int = LOG_SIZE) -> DataFrame:
    return lake.refresh(sketched(model, log_size), LAYER, TABLE)


def distinct_from_sketches(
    stored: DataFrame,
    dates: DataFrame,
    measures: Sequence[str],
    by: Sequence[str] = (),
    where: Mapping[str, Any] | None = None,
) -> DataFrame:
    """One row per axis value with approximate distinct counts, from sketches and the calendar.

    Axes and filters are those of ``evaluate``, of the stored grain or of the calendar.
    """
    grain = {name.split(".")[1]: name for name in GRAIN}
    context = Context.of(by, where)
    for axis in (*context.by, *(a for a, _ in context.where)):
        if axis.table != DATES and grain.get(axis.column) != f"{axis.table}.{axis.column}":
            raise ValueError(f"{axis.table}.{axis.column} is not in the stored grain")

    def to_fact(axis):
        return type(axis)("fact_orders", axis.column) if axis.table != DATES else axis

    # the sketches take the fact's place; what dimensions told is in their rows
    own = Context(tuple(map(to_fact, context.by)), tuple((to_fact(a), v) for a, v in context.where))
    rows = in_context({"fact_orders": stored, DATES: dates}, own, list(measures))
    counted = [F.hll_sketch_estimate(F.hll_union_agg(m)).alias(m) for m in measures]
    return rows.groupBy(*own.names).agg(*counted)
