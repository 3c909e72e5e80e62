"""Silver: one conforming function per bronze table, plus geolocation deduplication.

All but two are projections over one scan. Products join the category translation (Catalyst
broadcasts it while it stays under the session's size threshold) and geolocation aggregates.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelscope.functions.cleaning import (
    flag,
    payment_type_valid,
    present,
    safe_long,
    score_valid,
    to_long,
)
from parcelscope.functions.dates import whole_days
from parcelscope.schemas import DATETIME, MONEY

MEASUREMENTS = (
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
    "product_photos_qty",
)


def orders(bronze: DataFrame) -> DataFrame:
    """Adds delivery_days, is_late, days_late and is_delivered.

    An undelivered order is not late (0) and has null day counts. Late means delivered after the
    estimate, to the second; days_late is signed.
    """
    purchased = F.col("order_purchase_timestamp")
    delivered = F.col("order_delivered_customer_date")
    estimated = F.col("order_estimated_delivery_date")
    return bronze.withColumns(
        {
            "delivery_days": whole_days(purchased, delivered),
            "is_late": flag(delivered > estimated),
            "days_late": whole_days(estimated, delivered),
            "is_delivered": flag(delivered.isNotNull()),
        }
    )


def order_items(bronze: DataFrame) -> DataFrame:
    return bronze.withColumns(
        {
            "order_item_id": to_long(F.col("order_item_id")),
            "shipping_limit_date": F.col("shipping_limit_date").cast(DATETIME),
            "price": F.col("price").cast(MONEY),
            "freight_value": F.col("freight_value").cast(MONEY),
        }
    )


def order_payments(bronze: DataFrame) -> DataFrame:
    return bronze.withColumns(
        {
            "payment_sequential": to_long(F.col("payment_sequential")),
            "payment_installments": to_long(F.col("payment_installments")),
            "payment_value": F.col("payment_value").cast(MONEY),
            "payment_type_valid": payment_type_valid(F.col("payment_type")),
        }
    )


def order_reviews(bronze: DataFrame) -> DataFrame:
    """Replaces the raw score by the parsed one and flags scores on the 1 to 5 scale."""
    parsed = bronze.withColumn("review_score_clean", safe_long(F.col("review_score")))
    return (
        parsed.withColumn("review_score_valid", score_valid(F.col("review_score_clean")))
        .drop("review_score")
        .withColumnRenamed("review_score_clean", "review_score")
    )


def customers(bronze: DataFrame) -> DataFrame:
    zip_code = F.col("customer_zip_code_prefix")
    return bronze.withColumns(
        {
            "customer_state": F.upper("customer_state"),
            "has_zip": present(zip_code),
            "customer_zip_code_prefix": to_long(zip_code),
        }
    )


def sellers(bronze: DataFrame) -> DataFrame:
    return bronze.withColumns(
        {
            "seller_state": F.upper("seller_state"),
            "seller_zip_code_prefix": to_long(F.col("seller_zip_code_prefix")),
        }
    )


def products(bronze: DataFrame, translation: DataFrame) -> DataFrame:
    """Adds the English category; null when the category is null or has no translation."""
    names = translation.select("product_category_name", "product_category_name_english")
    return (
        bronze.join(names, "product_category_name", "left")
        .withColumnRenamed("product_category_name_english", "product_category_english")
        .withColumns({c: to_long(F.col(c)) for c in MEASUREMENTS})
        .select(*bronze.columns, "product_category_english")
    )


def corrected_spelling(products_df: DataFrame) -> DataFrame:
    """The two length columns under their corrected names, for consumers that ask for them."""
    return products_df.withColumnsRenamed(
        {
            "product_name_lenght": "product_name_length",
            "product_description_lenght": "product_description_length",
        }
    )


def geolocation(bronze: DataFrame) -> DataFrame:
    """One row per zip prefix, state and city with the mean coordinates."""
    return bronze.groupBy(
        "geolocation_zip_code_prefix", "geolocation_state", "geolocation_city"
    ).agg(
        F.avg("geolocation_lat").alias("geolocation_lat"),
        F.avg("geolocation_lng").alias("geolocation_lng"),
    )


SINGLE_SOURCE: dict[str, Callable[[DataFrame], DataFrame]] = {
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "customers": customers,
    "sellers": sellers,
    "geolocation": geolocation,
}


class Silver(Mapping[str, DataFrame]):
    """Silver tables, each built once on first use, from a function that returns a bronze table."""

    def __init__(self, bronze: Callable[[str], DataFrame]):
        self._bronze = bronze
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._built:
            self._built[table] = self._build(table)
        return self._built[table]

    def _build(self, table: str) -> DataFrame:
        if table == "products":
            return products(
                self._bronze("products"), self._bronze("product_category_translation")
            )
        return SINGLE_SOURCE[table](self._bronze(table))

    def __iter__(self):
        yield from (*SINGLE_SOURCE, "products")

    def __len__(self) -> int:
        return len(SINGLE_SOURCE) + 1
