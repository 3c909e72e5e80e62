"""The business questions the model was built for: lag and score, delay by region, concentration."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelscope.functions.ratios import ratio
from parcelscope.plans.measures import Context, in_context


def lag_vs_score(fact: DataFrame) -> DataFrame:
    """Mean review score by lateness band, and the correlation of days late with score overall.

    The row with band 'all' carries the correlation; it is null where either side does not vary.
    """
    late = F.col("days_late")
    band = (
        F.when(late < -7, "early by more than 7")
        .when(late < 0, "early by 1 to 7")
        .when(late == 0, "on the day")
        .when(late <= 7, "late by 1 to 7")
        .otherwise("late by more than 7")
    )
    scored = fact.where(late.isNotNull() & F.col("review_score").isNotNull()).select(
        band.alias("band"), "days_late", "review_score"
    )
    grouped = scored.rollup("band").agg(
        F.count(F.lit(1)).alias("n_items"),
        ratio(F.sum("review_score"), F.count("review_score")).alias("avg_review_score"),
        F.try_divide(
            F.covar_pop("days_late", "review_score"),
            F.stddev_pop("days_late") * F.stddev_pop("review_score"),
        ).alias("lag_score_corr"),
        F.grouping("band").alias("_all"),
    )
    overall = F.col("_all") == 1
    return grouped.select(
        F.when(overall, "all").otherwise(F.col("band")).alias("band"),
        "n_items",
        "avg_review_score",
        F.when(overall, F.col("lag_score_corr")).alias("lag_score_corr"),
    )


def delay_by_state(model: Mapping[str, DataFrame]) -> DataFrame:
    """Share of delivered item rows that came late, per customer state."""
    context = Context.of(by=["dim_customers.customer_state"])
    rows = in_context(model, context, ["is_late", "is_delivered", "days_late"])
    late = F.count_if(F.col("is_late") == 1)
    delivered = F.count_if(F.col("is_delivered") == 1)
    return rows.groupBy("customer_state").agg(
        late.alias("late_items"),
        delivered.alias("delivered_items"),
        ratio(late, delivered).alias("delay_rate"),
        F.avg(F.when(F.col("is_late") == 1, F.col("days_late"))).alias("avg_days_late"),
    )


def seller_concentration(fact: DataFrame) -> DataFrame:
    """How few sellers account for how many late items.

    One row per distinct late count: sellers with that count, and the share of sellers and of late
    items held by sellers with at least that many. Ranking sellers by count only (ties together)
    keeps the unpartitioned window small: D distinct positive counts imply at least D * D / 2 late
    items, so even 10^12 late items leave fewer than 1.5 million rows.
    """
    per_seller = fact.groupBy("seller_key").agg(
        F.count_if(F.col("is_late") == 1).alias("late_items")
    )
    counts = per_seller.groupBy("late_items").agg(F.count(F.lit(1)).alias("n_sellers"))
    down = W.orderBy(F.col("late_items").desc())
    everyone = W.partitionBy()
    late_total = F.col("late_items") * F.col("n_sellers")
    return counts.select(
        "late_items",
        "n_sellers",
        ratio(F.sum("n_sellers").over(down), F.sum("n_sellers").over(everyone)).alias(
            "cum_seller_share"
        ),
        ratio(F.sum(late_total).over(down), F.sum(late_total).over(everyone)).alias(
            "cum_late_share"
        ),
    )
