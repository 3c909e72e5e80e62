"""Gold: the star schema.

Grain changes happen before joins: payments, reviews and coordinates are reduced to the join key
first, so no join multiplies rows it should not. MD5 keys are computed once, in the last projection;
the joins themselves run on the natural ids, whose equality is the equality of their keys.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelscope.functions.dates import date_key
from parcelscope.functions.keys import surrogate_key
from parcelscope.functions.ratios import ratio
from parcelscope.operators.dedupe import latest_per_key
from parcelscope.operators.joins import hot_keys, known_join, spread_join
from parcelscope.plans.silver import Silver
from parcelscope.schemas import GOLD

# Columns that tell the items of one order apart, to spread a hot order.
ITEM_IDENTITY = ["order_id", "order_item_id", "product_id"]


def conform(df: DataFrame, table: str) -> DataFrame:
    """The declared columns in order and type. A value that does not fit its type is an error."""
    return df.to(GOLD[table])


def geo_by_zip(geolocation: DataFrame) -> DataFrame:
    """Mean of the city-level coordinates per zip prefix, every city weighing the same."""
    return geolocation.groupBy("geolocation_zip_code_prefix").agg(
        F.avg("geolocation_lat").alias("geolocation_lat"),
        F.avg("geolocation_lng").alias("geolocation_lng"),
    )


def _with_coordinates(
    df: DataFrame, zip_column: str, geolocation: DataFrame, rows: DataFrame, identity: list[str]
) -> DataFrame:
    """Coordinates by zip prefix. ``rows`` is what ``df`` was made from, cheaper to look for popular
    zips in; its ``identity`` column is also one of ``df``."""
    places = geo_by_zip(geolocation).withColumnRenamed("geolocation_zip_code_prefix", zip_column)
    popular = hot_keys(rows, zip_column, identity)
    return spread_join(df, places, popular, zip_column, identity, "left")


def dim_customers(customers: DataFrame, geolocation: DataFrame) -> DataFrame:
    """One row per person: the attributes of the highest customer_id."""
    people = latest_per_key(
        customers,
        ["customer_unique_id"],
        [F.col("customer_id")],
        ["customer_city", "customer_state", "customer_zip_code_prefix"],
    )
    placed = _with_coordinates(
        people, "customer_zip_code_prefix", geolocation, customers, ["customer_unique_id"]
    )
    return conform(
        placed.withColumn("customer_key", surrogate_key(F.col("customer_unique_id"))),
        "dim_customers",
    )


def seller_stats(items: DataFrame, orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Per seller, over every (item, review) pair of the same order: pairs, on-time share, score.

    Reviews are neither deduplicated nor filtered here, so an item of an order with two reviews
    counts twice. The pairs are never formed: reviews are reduced to counts and sums per order, each
    item carries its order's totals, and sellers add them up. Item rows cross the network once.
    """
    reviewed = reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.count("review_score").alias("n_scores"),
        F.sum("review_score").alias("sum_scores"),
    )
    pairs = F.coalesce(F.col("n_reviews"), F.lit(1))
    per_order = (
        orders.select("order_id", "is_late")
        .join(reviewed, "order_id", "left")
        .select(
            "order_id",
            pairs.alias("pairs"),
            F.when(F.col("is_late").isNotNull(), pairs).alias("timed"),
            (pairs * (1 - F.col("is_late"))).alias("on_time"),
            "n_scores",
            "sum_scores",
        )
    )
    sold = items.select("seller_id", *ITEM_IDENTITY)
    hot_orders = hot_keys(items, "order_id", ITEM_IDENTITY)
    rated = spread_join(sold, per_order, hot_orders, "order_id", ITEM_IDENTITY)
    return rated.groupBy("seller_id").agg(
        F.sum("pairs").alias("total_orders"),
        ratio(F.sum("on_time"), F.sum("timed")).alias("on_time_rate"),
        ratio(F.sum("sum_scores"), F.sum("n_scores")).alias("avg_review_score"),
    )


def dim_sellers(
    sellers: DataFrame,
    geolocation: DataFrame,
    items: DataFrame,
    orders: DataFrame,
    reviews: DataFrame,
) -> DataFrame:
    """One row per seller with coordinates and load-time statistics; both may be null."""
    placed = _with_coordinates(
        sellers, "seller_zip_code_prefix", geolocation, sellers, ["seller_id"]
    )
    rated = placed.join(seller_stats(items, orders, reviews), "seller_id", "left")
    return conform(
        rated.withColumn("seller_key", surrogate_key(F.col("seller_id"))), "dim_sellers"
    )


def dim_products(products: DataFrame) -> DataFrame:
    return conform(
        products.withColumn("product_key", surrogate_key(F.col("product_id"))), "dim_products"
    )


def latest_review(reviews: DataFrame) -> DataFrame:
    """The score of each order's latest valid review; a null answer time ranks last."""
    return latest_per_key(
        reviews.where(F.col("review_score_valid") == 1),
        ["order_id"],
        [F.col("review_answer_timestamp"), F.col("review_id")],
        ["review_score"],
    )


def payments_agg(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(F.sum("payment_value").alias("payment_value"))


def customer_lookup(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "customer_unique_id").distinct()


def fact_orders(
    silver: Mapping[str, DataFrame],
    dims: Mapping[str, DataFrame],
    sep: str = "",
) -> DataFrame:
    """One row per order item, the order's payment total repeated on each of its items; ``sep`` goes
    into the item key only."""
    return keyed(fact_rows(silver, dims), sep)


def keyed(rows: DataFrame, sep: str = "") -> DataFrame:
    """``fact_rows`` with their surrogate keys, as the fact table."""
    return conform(
        rows.withColumns(
            {
                "order_item_key": surrogate_key(
                    F.col("order_id"), F.col("order_item_id"), sep=sep
                ),
                "customer_key": surrogate_key(F.col("customer_unique_id")),
                "seller_key": surrogate_key(F.col("seller_id")),
                "product_key": surrogate_key(F.col("product_id")),
            }
        ),
        "fact_orders",
    )


def fact_rows(
    silver: Mapping[str, DataFrame],
    dims: Mapping[str, DataFrame],
    axes: Mapping[str, list[str]] | None = None,
) -> DataFrame:
    """The rows of the fact under their natural ids, which take a third of the space of hashed keys.

    Items without a known order, customer, seller or product are left out; missing payments and
    reviews stay null. Shuffles: everything about an order (customer, review, payments) meets at
    order grain first, of the items only ids meet sellers and products where nearly all are known,
    and the item rows cross the network once, for the order. A hot seller or product is split by
    adaptive execution; a hot order or customer, whose other side is computed on the join key, is
    spread explicitly.

    ``axes`` names more columns of ``dim_customers`` and ``dim_products`` that the rows carry, as a
    join of the fact to that dimension would add them: customers at order grain, products where the
    items meet them anyway.
    """
    axes = axes or {}
    orders = silver["orders"].select(
        "order_id",
        "customer_id",
        "order_status",
        date_key(F.col("order_purchase_timestamp")).alias("order_date_key"),
        date_key(F.col("order_delivered_customer_date")).alias("delivery_date_key"),
        date_key(F.col("order_estimated_delivery_date")).alias("estimated_delivery_date_key"),
        "delivery_days",
        "days_late",
        "is_late",
        "is_delivered",
    )
    lookup = customer_lookup(silver["customers"])
    of_people = axes.get("dim_customers", [])
    if isinstance(dims, Gold) and dims.silver["customers"] is silver["customers"] and not of_people:
        # the dimension is made from these very customers: it knows all that have a person
        known_people = lookup.where(F.col("customer_unique_id").isNotNull())
    else:
        hot_people = hot_keys(silver["customers"], "customer_unique_id", ["customer_id"])
        people = dims["dim_customers"].select("customer_unique_id", *of_people)
        known_people = spread_join(lookup, people, hot_people, "customer_unique_id", ["customer_id"])
    known_orders = (
        orders.join(known_people, "customer_id")
        .join(latest_review(silver["order_reviews"]), "order_id", "left")
        .join(payments_agg(silver["order_payments"]), "order_id", "left")
    )
    items = silver["order_items"].select(
        "order_id", "order_item_id", "seller_id", "product_id", "price", "freight_value"
    )
    known_items = known_join(items, dims["dim_sellers"], "seller_id", items)
    products, of_products = dims["dim_products"], axes.get("dim_products", [])
    if of_products:
        # twice, as a product that comes twice multiplies the fact and the join to its dimension
        known_items = known_items.join(products.select("product_id"), "product_id").join(
            products.select("product_id", *of_products), "product_id"
        )
    else:
        known_items = known_join(known_items, products, "product_id", items)
    hot_orders = hot_keys(items, "order_id", ITEM_IDENTITY)
    return spread_join(known_items, known_orders, hot_orders, "order_id", ITEM_IDENTITY)


class Gold(Mapping[str, DataFrame]):
    """Dimensions and fact, each built once on first use, from the silver tables and a calendar."""

    def __init__(self, silver: Silver | Mapping[str, DataFrame], dates: DataFrame):
        self.silver = silver
        self.dates = dates
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._built:
            self._built[table] = self._build(table)
        return self._built[table]

    def _build(self, table: str) -> DataFrame:
        s = self.silver
        if table == "dim_date":
            return self.dates
        if table == "dim_customers":
            return dim_customers(s["customers"], s["geolocation"])
        if table == "dim_sellers":
            return dim_sellers(
                s["sellers"], s["geolocation"], s["order_items"], s["orders"], s["order_reviews"]
            )
        if table == "dim_products":
            return dim_products(s["products"])
        if table == "fact_orders":
            return self.fact(self)
        raise KeyError(table)

    def fact(self, dims: Mapping[str, DataFrame]) -> DataFrame:
        """The fact against given dimensions, for instance stored ones."""
        return fact_orders(self.silver, dims)

    def rows(self, axes: Mapping[str, list[str]] | None = None) -> DataFrame:
        """The fact's rows before their keys are hashed, with ``axes`` of its dimensions."""
        return fact_rows(self.silver, self, axes)

    def __iter__(self):
        yield from GOLD

    def __len__(self) -> int:
        return len(GOLD)
