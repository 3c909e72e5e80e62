"""Table schemas and the load registry.

Timestamps are ``TIMESTAMP_NTZ``: the extracts carry wall-clock times without a zone, and whole-day
arithmetic on them must not depend on the session zone or on daylight saving.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

STRING = T.StringType()
LONG = T.LongType()
INT = T.IntegerType()
SHORT = T.ShortType()
DOUBLE = T.DoubleType()
BOOL = T.BooleanType()
DATE = T.DateType()
MONEY = T.DecimalType(10, 2)
DATETIME = T.TimestampNTZType()


def struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


BRONZE: dict[str, T.StructType] = {
    "orders": struct(
        ("order_id", STRING),
        ("customer_id", STRING),
        ("order_status", STRING),
        ("order_purchase_timestamp", DATETIME),
        ("order_approved_at", DATETIME),
        ("order_delivered_carrier_date", DATETIME),
        ("order_delivered_customer_date", DATETIME),
        ("order_estimated_delivery_date", DATETIME),
    ),
    "order_items": struct(
        ("order_id", STRING),
        ("order_item_id", LONG),
        ("product_id", STRING),
        ("seller_id", STRING),
        ("shipping_limit_date", DATETIME),
        ("price", MONEY),
        ("freight_value", MONEY),
    ),
    "order_payments": struct(
        ("order_id", STRING),
        ("payment_sequential", LONG),
        ("payment_type", STRING),
        ("payment_installments", LONG),
        ("payment_value", MONEY),
    ),
    "order_reviews": struct(
        ("review_id", STRING),
        ("order_id", STRING),
        ("review_score", STRING),  # dirty at the source, parsed in silver
        ("review_comment_title", STRING),
        ("review_comment_message", STRING),
        ("review_creation_date", DATETIME),
        ("review_answer_timestamp", DATETIME),
    ),
    "customers": struct(
        ("customer_id", STRING),
        ("customer_unique_id", STRING),
        ("customer_zip_code_prefix", LONG),
        ("customer_city", STRING),
        ("customer_state", STRING),
    ),
    "sellers": struct(
        ("seller_id", STRING),
        ("seller_zip_code_prefix", LONG),
        ("seller_city", STRING),
        ("seller_state", STRING),
    ),
    "products": struct(
        ("product_id", STRING),
        ("product_category_name", STRING),
        ("product_name_lenght", LONG),  # source spelling
        ("product_description_lenght", LONG),  # source spelling
        ("product_photos_qty", LONG),
        ("product_weight_g", LONG),
        ("product_length_cm", LONG),
        ("product_height_cm", LONG),
        ("product_width_cm", LONG),
    ),
    "product_category_translation": struct(
        ("product_category_name", STRING),
        ("product_category_name_english", STRING),
    ),
    "geolocation": struct(
        ("geolocation_zip_code_prefix", LONG),
        ("geolocation_lat", DOUBLE),
        ("geolocation_lng", DOUBLE),
        ("geolocation_city", STRING),
        ("geolocation_state", STRING),
    ),
}

GOLD: dict[str, T.StructType] = {
    "dim_customers": struct(
        ("customer_key", STRING),
        ("customer_unique_id", STRING),
        ("customer_city", STRING),
        ("customer_state", STRING),
        ("geolocation_lat", DOUBLE),
        ("geolocation_lng", DOUBLE),
    ),
    "dim_sellers": struct(
        ("seller_key", STRING),
        ("seller_id", STRING),
        ("seller_city", STRING),
        ("seller_state", STRING),
        ("geolocation_lat", DOUBLE),
        ("geolocation_lng", DOUBLE),
        ("total_orders", LONG),
        ("on_time_rate", DOUBLE),
        ("avg_review_score", DOUBLE),
    ),
    "dim_products": struct(
        ("product_key", STRING),
        ("product_id", STRING),
        ("product_category_english", STRING),
        ("product_weight_g", INT),
        ("product_length_cm", INT),
        ("product_height_cm", INT),
        ("product_width_cm", INT),
    ),
    "dim_date": struct(
        ("date_key", INT),
        ("full_date", DATE),
        ("year", SHORT),
        ("quarter", SHORT),
        ("quarter_name", STRING),
        ("month", SHORT),
        ("month_name", STRING),
        ("month_year", STRING),
        ("week_of_year", SHORT),
        ("day_of_month", SHORT),
        ("day_of_week", SHORT),
        ("day_name", STRING),
        ("is_weekend", BOOL),
        ("is_month_end", BOOL),
        ("year_offset", SHORT),
    ),
    "fact_orders": struct(
        ("order_item_key", STRING),
        ("order_id", STRING),
        ("order_item_id", INT),
        ("customer_key", STRING),
        ("seller_key", STRING),
        ("product_key", STRING),
        ("order_date_key", INT),
        ("delivery_date_key", INT),
        ("estimated_delivery_date_key", INT),
        ("price", MONEY),
        ("freight_value", MONEY),
        ("payment_value", MONEY),
        ("review_score", SHORT),
        ("delivery_days", INT),
        ("days_late", INT),
        ("is_late", SHORT),
        ("is_delivered", SHORT),
        ("order_status", STRING),
    ),
}

RUN_LOG = struct(
    ("run_id", STRING),
    ("table_name", STRING),
    ("source_file", STRING),
    ("run_timestamp", T.TimestampType()),
    ("rows_loaded", LONG),
    ("status", STRING),
    ("error_message", STRING),
)
HIGH_WATER = struct(("table_name", STRING), ("last_loaded_date", DATE), ("last_run_id", STRING))
QUALITY_LOG = struct(
    ("table_name", STRING),
    ("check_type", STRING),
    ("result", STRING),
    ("passed", BOOL),
    ("run_timestamp", T.TimestampType()),
    ("run_id", STRING),
)


@dataclass(frozen=True)
class TableSpec:
    """How one source table is loaded and checked.

    ``event_column`` makes the load incremental. ``multi_line`` is set only where quoted text may
    hold line breaks, because such files cannot be split across tasks. ``pk_null_blocks`` and
    ``check_duplicates`` carry the quality suite's per-table exemptions.
    """

    name: str
    key: tuple[str, ...]
    event_column: str | None = None
    date_range_column: str | None = None
    partition_by: tuple[str, ...] = ()
    multi_line: bool = False
    pk_null_blocks: bool = True
    check_duplicates: bool = True

    @property
    def schema(self) -> T.StructType:
        return BRONZE[self.name]

    @property
    def row_key(self) -> tuple[str, ...]:
        """What tells a row already loaded: the key, with the order where the key may repeat."""
        more = "order_id" if not self.check_duplicates and "order_id" in BRONZE[self.name].fieldNames() else None
        return self.key if more is None else (*self.key, more)


SPECS: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec(
            "orders",
            ("order_id",),
            event_column="order_purchase_timestamp",
            date_range_column="order_purchase_timestamp",
        ),
        TableSpec("order_items", ("order_id", "order_item_id")),
        TableSpec("order_payments", ("order_id", "payment_sequential")),
        TableSpec(
            "order_reviews",
            ("review_id",),
            event_column="review_creation_date",
            date_range_column="review_creation_date",
            multi_line=True,
            pk_null_blocks=False,
            check_duplicates=False,
        ),
        TableSpec("customers", ("customer_id",)),
        TableSpec("sellers", ("seller_id",)),
        TableSpec("products", ("product_id",)),
        TableSpec("product_category_translation", ("product_category_name",)),
        TableSpec(
            "geolocation",
            ("geolocation_zip_code_prefix",),
            partition_by=("geolocation_state",),
            check_duplicates=False,
        ),
    )
}
