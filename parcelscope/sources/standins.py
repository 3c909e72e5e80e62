"""The provided star-schema tables recast as the marketplace's nine bronze tables.

The provided data has no reviews, payments or coordinates, so neighbouring columns stand in for
them. Every definition is a plain projection, join or aggregate over whole tables; the same
definitions in SQL are in ``parcelscope.oracle``.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelscope.schemas import BRONZE, DATETIME, DOUBLE, INT, LONG, STRING, struct

# The provided tables. Stated, so that opening one needs no footer-reading job.
SOURCES = {
    "orders": struct(
        ("o_orderkey", LONG),
        ("o_custkey", LONG),
        ("o_orderstatus", STRING),
        ("o_totalprice", DOUBLE),
        ("o_orderdate", DATETIME),
        ("o_orderpriority", STRING),
    ),
    "lineitem": struct(
        ("l_orderkey", LONG),
        ("l_partkey", LONG),
        ("l_suppkey", LONG),
        ("l_linenumber", INT),
        ("l_quantity", DOUBLE),
        ("l_extendedprice", DOUBLE),
        ("l_shipdate", DATETIME),
    ),
    "customer": struct(
        ("c_custkey", LONG), ("c_nationkey", INT), ("c_acctbal", DOUBLE), ("c_mktsegment", STRING)
    ),
    "supplier": struct(("s_suppkey", LONG), ("s_name", STRING), ("s_nationkey", INT)),
    "part": struct(
        ("p_partkey", LONG),
        ("p_name", STRING),
        ("p_type", STRING),
        ("p_size", INT),
        ("p_retailprice", DOUBLE),
    ),
    "nation": struct(("n_nationkey", INT), ("n_name", STRING)),
    "events": struct(
        ("event_id", LONG),
        ("ts", DATETIME),
        ("user_id", LONG),
        ("event_type", STRING),
        ("value", DOUBLE),
        ("props", STRING),
    ),
}

HOURS = "make_dt_interval(0, {})"


class Standins:
    """Lazy bronze tables over one folder of provided Parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.source = cache(self._source)
        self.bronze = cache(self._bronze)

    def _source(self, table: str) -> DataFrame:
        return self.spark.read.schema(SOURCES[table]).parquet(f"{self.folder}/{table}.parquet")

    def _bronze(self, table: str) -> DataFrame:
        return getattr(self, table)().to(BRONZE[table])

    def orders(self) -> DataFrame:
        """Orders with the last shipment of their lines as delivery; open ('P') ones undelivered."""
        shipped = (
            self.source("lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))
        )
        arrival = F.col("last_ship") + F.expr(HOURS.format(6))
        return (
            self.source("orders")
            .join(shipped, "o_orderkey", "left")
            .select(
                F.col("o_orderkey").cast("string").alias("order_id"),
                F.col("o_orderkey").cast("string").alias("customer_id"),
                F.col("o_orderstatus").alias("order_status"),
                F.col("o_orderdate").alias("order_purchase_timestamp"),
                F.col("o_orderdate").alias("order_approved_at"),
                F.col("first_ship").alias("order_delivered_carrier_date"),
                F.when(F.col("o_orderstatus") != "P", arrival).alias(
                    "order_delivered_customer_date"
                ),
                (F.col("o_orderdate") + F.expr("make_dt_interval(30, 12)")).alias(
                    "order_estimated_delivery_date"
                ),
            )
        )

    def order_items(self) -> DataFrame:
        return self.source("lineitem").select(
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("l_linenumber").cast("long").alias("order_item_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_suppkey").cast("string").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            F.col("l_extendedprice").alias("price"),
            F.col("l_quantity").alias("freight_value"),
        )

    def order_payments(self) -> DataFrame:
        """One payment of the order total; urgent orders pay a second one of 10.00."""
        first = F.struct(F.lit(1).alias("seq"), F.col("o_totalprice").alias("value"))
        second = F.struct(F.lit(2).alias("seq"), F.lit(10.0).alias("value"))
        urgent = F.col("o_orderpriority") == "1-URGENT"
        payments = F.when(urgent, F.array(first, second)).otherwise(F.array(first))
        kind = (
            F.when(urgent, "credit_card")
            .when(F.col("o_orderpriority") == "2-HIGH", "boleto")
            .when(F.col("o_orderpriority") == "3-MEDIUM", "voucher")
            .when(F.col("o_orderpriority") == "5-LOW", "debit_card")
            .otherwise("not_defined")
        )
        return (
            self.source("orders")
            .select("o_orderkey", kind.alias("kind"), F.explode(payments).alias("p"))
            .select(
                F.col("o_orderkey").cast("string").alias("order_id"),
                F.col("p.seq").alias("payment_sequential"),
                F.col("kind").alias("payment_type"),
                F.lit(1).alias("payment_installments"),
                F.col("p.value").alias("payment_value"),
            )
        )

    def order_reviews(self) -> DataFrame:
        """Four events review three orders, so every third order has two reviews."""
        score = (F.floor(F.col("value") / 40) + 1).cast("long").cast("string")
        return self.source("events").select(
            F.col("event_id").cast("string").alias("review_id"),
            F.expr("event_id * 3 div 4").cast("string").alias("order_id"),
            F.when(F.col("event_type") == "error", "txt").otherwise(score).alias("review_score"),
            F.col("event_type").alias("review_comment_title"),
            F.col("props").alias("review_comment_message"),
            F.date_trunc("day", "ts").cast(DATETIME).alias("review_creation_date"),
            F.col("ts").alias("review_answer_timestamp"),
        )

    def customers(self) -> DataFrame:
        """One row per order, so a person with many orders appears many times."""
        city = F.when(F.col("o_orderstatus") == "F", F.lower("c_mktsegment")).otherwise(
            F.col("c_mktsegment")
        )
        return (
            self.source("orders")
            .join(self.source("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(self.source("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("o_orderkey").cast("string").alias("customer_id"),
                F.col("o_custkey").cast("string").alias("customer_unique_id"),
                F.nullif(F.col("c_nationkey"), F.lit(0)).alias("customer_zip_code_prefix"),
                city.alias("customer_city"),
                F.lower("n_name").alias("customer_state"),
            )
        )

    def sellers(self) -> DataFrame:
        return (
            self.source("supplier")
            .join(self.source("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").cast("string").alias("seller_id"),
                F.col("s_nationkey").alias("seller_zip_code_prefix"),
                F.col("s_name").alias("seller_city"),
                F.lower("n_name").alias("seller_state"),
            )
        )

    def products(self) -> DataFrame:
        size = F.col("p_size")
        return self.source("part").select(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.col("p_type").alias("product_category_name"),
            F.length("p_name").alias("product_name_lenght"),
            size.alias("product_description_lenght"),
            F.nullif(size % 7, F.lit(0)).alias("product_photos_qty"),
            F.bround(F.col("p_retailprice") / 2).alias("product_weight_g"),
            size.alias("product_length_cm"),
            F.bround(size * 2.5).alias("product_height_cm"),
            size.alias("product_width_cm"),
        )

    def product_category_translation(self) -> DataFrame:
        """Every category in use but two, so that some products stay untranslated."""
        return (
            self.source("part")
            .where(~F.col("p_type").isin("PROMO", "STANDARD"))
            .select(
                F.col("p_type").alias("product_category_name"),
                F.lower("p_type").alias("product_category_name_english"),
            )
            .distinct()
        )

    def geolocation(self) -> DataFrame:
        return (
            self.source("customer")
            .join(self.source("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_nationkey").alias("geolocation_zip_code_prefix"),
                F.col("c_acctbal").alias("geolocation_lat"),
                (-F.col("c_acctbal")).alias("geolocation_lng"),
                F.lower("c_mktsegment").alias("geolocation_city"),
                F.col("n_name").alias("geolocation_state"),
            )
        )
