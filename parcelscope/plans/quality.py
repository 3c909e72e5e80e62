"""Data-quality suites for the three layers.

Every suite returns rows of (table_name, check_type, result, passed). Each table is aggregated once
for all of its checks; orphan searches count keys before they join, so a key's popularity does not
matter. Nothing is collected: a suite is a DataFrame, and ``logged`` appends it to the quality log.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelscope.functions.ratios import ratio
from parcelscope.operators.checks import check, percent, stacked, text, to_rows
from parcelscope.operators.joins import totals_side_by_side
from parcelscope.operators.references import Relation, orphans
from parcelscope.schemas import SPECS

Expected = int | DataFrame | None

# (child table, column, parent table)
SILVER_REFERENCES = (
    ("order_items", "order_id", "orders"),
    ("order_items", "seller_id", "sellers"),
    ("order_items", "product_id", "products"),
    ("order_payments", "order_id", "orders"),
    ("order_reviews", "order_id", "orders"),
    ("orders", "customer_id", "customers"),
)
SILVER_REQUIRED = {
    "orders": ("order_id", "customer_id"),
    "order_items": ("order_id", "seller_id", "product_id"),
    "order_payments": ("order_id",),
    "order_reviews": ("order_id",),
}
# column: (low, high), inclusive, None for open
SILVER_RANGES = {
    "order_reviews": {"review_score": (1, 5)},
    "order_payments": {"payment_value": (0, None)},
    "orders": {"delivery_days": (-30, 365)},
}
# (fact column, dimension, dimension key, null allowed)
GOLD_REFERENCES = (
    ("customer_key", "dim_customers", "customer_key", False),
    ("seller_key", "dim_sellers", "seller_key", False),
    ("product_key", "dim_products", "product_key", False),
    ("order_date_key", "dim_date", "date_key", True),
    ("delivery_date_key", "dim_date", "date_key", True),
    ("estimated_delivery_date_key", "dim_date", "date_key", True),
)
# Declared lengths of the dimension text columns.
GOLD_LENGTHS = {
    "dim_customers": {"customer_unique_id": 50, "customer_city": 100, "customer_state": 2},
    "dim_sellers": {"seller_id": 50, "seller_city": 100, "seller_state": 2},
    "dim_products": {"product_id": 50, "product_category_english": 100},
}
GOLD_REQUIRED = ("customer_key", "seller_key", "product_key", "order_date_key")


def _count() -> Column:
    return F.count(F.lit(1))


def _with_expected(totals: DataFrame, expected: Expected) -> DataFrame:
    """Attach the expected count: a number, or the single number of a one-row frame."""
    if isinstance(expected, DataFrame):
        return totals_side_by_side(totals, expected.toDF("expected"))
    return totals.withColumn("expected", F.lit(expected).cast("long"))


def bronze_suite(
    tables: Mapping[str, DataFrame], expected: Mapping[str, Expected], tolerance: float = 0.05
) -> DataFrame:
    """Row count within tolerance, null keys, duplicate keys and date range, per table."""
    return stacked([_bronze_table(t, tables[t], expected.get(t), tolerance) for t in tables])


def _bronze_table(
    name: str, df: DataFrame, expected: Expected, tolerance: float
) -> DataFrame:
    totals = df.agg(*bronze_totals(name).values())
    return bronze_checks(name, totals, expected, tolerance)


def bronze_totals(name: str) -> dict[str, Column]:
    """The totals that a bronze table is judged by, by name."""
    spec = SPECS[name]
    key_null = reduce(or_, [F.col(column).isNull() for column in spec.key])
    totals = {"n": _count(), "null_keys": F.count_if(key_null)}
    if spec.check_duplicates:
        # a struct counts a key with a null part once, as a distinct over rows does
        totals["n_keys"] = F.count_distinct(F.struct(*spec.key))
    if spec.date_range_column:
        totals["first"] = F.min(spec.date_range_column)
        totals["last"] = F.max(spec.date_range_column)
    return {total: column.alias(total) for total, column in totals.items()}


def bronze_checks(name: str, totals: DataFrame, expected: Expected, tolerance: float) -> DataFrame:
    """The check rows of one bronze table from its one row of totals."""
    spec = SPECS[name]
    off = ratio(F.abs(F.col("n") - F.col("expected")), F.col("expected"))
    keys = ", ".join(spec.key)
    checks = [
        check(
            name,
            "row_count",
            text(F.col("n"), " rows for about ", F.col("expected"), " (off by ", percent(off, 1), ")"),
            off <= tolerance,
        ),
        check(
            name,
            "pk_null_rate",
            text(F.col("null_keys"), f" nulls in {keys}"),
            F.col("null_keys") == 0 if spec.pk_null_blocks else True,
        ),
    ]
    if spec.check_duplicates:
        duplicates = F.col("n") - F.col("n_keys")
        checks.append(
            check(name, "pk_duplicates", text(duplicates, f" duplicates on {keys}"), duplicates == 0)
        )
    else:
        checks.append(
            check(name, "pk_duplicates", F.lit("skipped, key not unique by design"), True)
        )
    if spec.date_range_column:
        checks.append(
            check(name, "date_range", text(_clock("first"), " to ", _clock("last")), True)
        )
    return to_rows(_with_expected(totals, expected), checks)


def _clock(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def silver_suite(
    tables: Mapping[str, DataFrame],
    bronze_counts: Mapping[str, Expected],
    orphan_tolerance: int = 25,
    revenue_tolerance: float = 0.30,
    invalid_score_tolerance: int = 50,
) -> DataFrame:
    """Reconciliation with bronze, required keys, references, ranges, revenue and validity flags."""
    own = [
        _silver_table(t, tables[t], bronze_counts.get(t), invalid_score_tolerance) for t in tables
    ]
    references = silver_references(tables, orphan_tolerance)
    return stacked([*own, references, _silver_revenue(tables, revenue_tolerance)])


def _silver_table(
    name: str, df: DataFrame, bronze_count: Expected, invalid_score_tolerance: int
) -> DataFrame:
    n = F.col("n")
    totals = [_count().alias("n")]
    if bronze_count is None:
        checks = [check(name, "row_count_reconciliation", text("deduplicated, silver ", n), True)]
    else:
        checks = [
            check(
                name,
                "row_count_reconciliation",
                text("bronze ", F.col("expected"), ", silver ", n),
                n <= F.col("expected"),
            )
        ]
    for column in SILVER_REQUIRED.get(name, ()):
        nulls = F.col(f"null_{column}")
        totals.append(F.count_if(F.col(column).isNull()).alias(f"null_{column}"))
        rate = F.coalesce(ratio(nulls, n), F.lit(0.0))
        checks.append(
            check(
                name,
                f"null_rate_{column}",
                text(nulls, " nulls (", percent(rate, 2), ")"),
                nulls == 0,
            )
        )
    for column, (low, high) in SILVER_RANGES.get(name, {}).items():
        least, most = F.col(f"min_{column}"), F.col(f"max_{column}")
        totals += [F.min(column).alias(f"min_{column}"), F.max(column).alias(f"max_{column}")]
        inside = F.lit(True)
        if low is not None:
            inside = inside & (least >= low)
        if high is not None:
            inside = inside & (most <= high)
        result = F.when(least.isNull(), F.lit("no rows")).otherwise(
            text("min=", least, ", max=", most)
        )
        checks.append(
            check(name, f"range_{column}", result, F.coalesce(inside, F.lit(True)))
        )
    invalid = F.col("invalid")
    if name == "order_reviews":
        totals.append(F.count_if(F.col("review_score_valid") == 0).alias("invalid"))
        checks.append(
            check(
                name,
                "review_score_valid_flag",
                text(invalid, " reviews with an invalid score, of ", n),
                invalid <= invalid_score_tolerance,
            )
        )
    if name == "order_payments":
        totals.append(F.count_if(F.col("payment_type_valid") == 0).alias("invalid"))
        checks.append(
            check(
                name,
                "payment_type_valid_flag",
                text(invalid, " payments of an unlisted type, of ", n),
                True,
            )
        )
    return to_rows(_with_expected(df.agg(*totals), bronze_count), checks)


def silver_references(tables: Mapping[str, DataFrame], tolerance: int) -> DataFrame:
    """One check row per reference; a null counts as one key without a parent."""
    ends = {t: tables[t] for child, _, parent in SILVER_REFERENCES for t in (child, parent)}
    found = orphans([Relation(ends[c], column, ends[p], column) for c, column, p in SILVER_REFERENCES])
    checks = []
    for k, (child, column, _) in enumerate(SILVER_REFERENCES):
        n = F.col(f"keys_{k}") + (F.col(f"nulls_{k}") > 0).cast("long")
        result = text(n, " keys without a parent")
        checks.append(check(child, f"ref_integrity_{column}", result, n <= tolerance))
    return to_rows(found, checks)


def _silver_revenue(tables: Mapping[str, DataFrame], tolerance: float) -> DataFrame:
    paid = tables["order_payments"].agg(F.sum("payment_value").alias("paid"))
    sold = tables["order_items"].agg(F.sum(F.col("price") + F.col("freight_value")).alias("sold"))
    paid_total, sold_total = F.col("paid"), F.col("sold")
    off = ratio(F.abs(paid_total - sold_total), sold_total)
    return to_rows(
        totals_side_by_side(paid, sold),
        [
            check(
                "order_payments",
                "revenue_reconciliation",
                text(
                    "payments=", paid_total, ", items=", sold_total, ", variance=", percent(off, 2)
                ),
                off <= tolerance,
            )
        ],
    )


def gold_suite(
    gold: Mapping[str, DataFrame],
    silver: Mapping[str, DataFrame],
    revenue_tolerance: float = 0.01,
    null_score_tolerance: int = 6000,
) -> DataFrame:
    """Completeness, references, key nulls, score range and revenue of the fact table.

    The fact is read once for its own checks, once for revenue and once for all references, each time
    only the columns needed; pass a stored table.
    """
    fact = gold["fact_orders"]
    return stacked(
        [
            _gold_fact(fact, silver["order_items"], null_score_tolerance),
            gold_references(gold),
            _gold_revenue(
                fact, silver["order_payments"], silver["order_items"], revenue_tolerance
            ),
        ]
    )


def _gold_fact(fact: DataFrame, items: DataFrame, null_score_tolerance: int) -> DataFrame:
    score = F.col("review_score")
    totals = fact.agg(
        _count().alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in GOLD_REQUIRED],
        F.count_if(~score.between(1, 5)).alias("out_of_range"),
        F.count_if(score.isNull()).alias("null_scores"),
    )
    both = totals_side_by_side(totals, items.agg(_count().alias("n_items")))
    n, n_items = F.col("n"), F.col("n_items")
    name = "fact_orders"
    return to_rows(
        both,
        [
            check(
                name, "fact_vs_silver_order_items", text("fact ", n, ", silver ", n_items), n == n_items
            ),
            *[
                check(
                    name, f"null_{c}", text(F.col(f"null_{c}"), " nulls"), F.col(f"null_{c}") == 0
                )
                for c in GOLD_REQUIRED
            ],
            check(
                name,
                "review_score_out_of_range",
                text(F.col("out_of_range"), " rows"),
                F.col("out_of_range") == 0,
            ),
            check(
                name,
                "review_score_null_count",
                text(F.col("null_scores"), f" rows (up to {null_score_tolerance} tolerated)"),
                F.col("null_scores") <= null_score_tolerance,
            ),
        ],
    )


def gold_references(gold: Mapping[str, DataFrame]) -> DataFrame:
    """One check row per reference of the fact, in rows without a match."""
    tables = {t: gold[t] for t in {"fact_orders", *(dim for _, dim, _, _ in GOLD_REFERENCES)}}
    relations = [Relation(tables["fact_orders"], c, tables[dim], key) for c, dim, key, _ in GOLD_REFERENCES]
    checks = []
    for k, (column, _, _, null_allowed) in enumerate(GOLD_REFERENCES):
        n = F.col(f"rows_{k}") if null_allowed else F.col(f"rows_{k}") + F.col(f"nulls_{k}")
        checks.append(check("fact_orders", f"{column}_orphans", text(n, " orphans"), n == 0))
    return to_rows(orphans(relations), checks)


def _gold_revenue(
    fact: DataFrame, payments: DataFrame, items: DataFrame, tolerance: float
) -> DataFrame:
    """Fact revenue, each (order, payment) once, against the payments of orders that have items."""
    of_fact = (
        fact.where(F.col("payment_value").isNotNull())
        .select("order_id", "payment_value")
        .distinct()
        .agg(F.sum("payment_value").alias("fact_revenue"))
    )
    # one row per order and task crosses the shuffle, on either side
    with_items = items.select("order_id").distinct()
    paid = payments.groupBy("order_id").agg(F.sum("payment_value").alias("paid"))
    of_silver = paid.join(with_items, "order_id", "left_semi").agg(F.sum("paid").alias("silver_revenue"))
    fact_revenue, silver_revenue = F.col("fact_revenue"), F.col("silver_revenue")
    off = ratio(F.abs(fact_revenue - silver_revenue), silver_revenue)
    return to_rows(
        totals_side_by_side(of_fact, of_silver),
        [
            check(
                "fact_orders",
                "revenue_reconciliation",
                text(
                    "fact=", fact_revenue, ", silver=", silver_revenue, ", variance=", percent(off, 4)
                ),
                off <= tolerance,
            )
        ],
    )


def length_suite(gold: Mapping[str, DataFrame]) -> DataFrame:
    """Text values longer than the warehouse declares; Spark strings have no length of their own."""
    return stacked([too_long(gold[t], t, limits) for t, limits in GOLD_LENGTHS.items()])


def unique_keys(df: DataFrame, name: str, key: str) -> DataFrame:
    """One check row: is ``key`` unique in ``df``? Used on keys that are hashed from parts."""
    totals = df.agg((_count() - F.count_distinct(key)).alias("n"))
    n = F.col("n")
    return to_rows(totals, [check(name, f"unique_{key}", text(n, " repeats"), n == 0)])


def too_long(df: DataFrame, name: str, limits: Mapping[str, int]) -> DataFrame:
    """One check row per text column: values longer than its declared length."""
    totals = df.agg(*[F.count_if(F.length(c) > size).alias(c) for c, size in limits.items()])
    return to_rows(
        totals,
        [
            check(name, f"length_{c}", text(F.col(c), f" values over {size}"), F.col(c) == 0)
            for c, size in limits.items()
        ],
    )


def summary(suite: DataFrame) -> DataFrame:
    """How many checks passed and failed."""
    return suite.groupBy("passed").agg(_count().alias("n_checks"))


def failures(suite: DataFrame) -> DataFrame:
    return suite.where(~F.col("passed"))


def stamped(suite: DataFrame) -> DataFrame:
    """The suite as rows of the quality log."""
    return suite.withColumn("run_timestamp", F.current_timestamp())
