"""Every registered query: a function of (session, data folder) to a DataFrame.

Queries read the provided tables through the stand-in bronze tables and are lazy plans from the
Parquet scan to the result, except the ones about writing (``in_*``, ``st_*``, ``qc_gold``), which
write to the shared scratch folder and read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelscope.operators.dedupe import latest_per_key
from parcelscope.plans import analyses, gold, quality
from parcelscope.plans.calendar import calendar, calendar_over
from parcelscope.plans.control import Ledger
from parcelscope.plans.gold import Gold
from parcelscope.plans.history import apply_snapshot, as_of_join
from parcelscope.plans.ingest import MODES, after_mark, bronze_table, full_load, incremental_load, rejects, rescued
from parcelscope.plans.footers import suite_from_footers
from parcelscope.plans.measures import SUMMABLE, Role, evaluate, implicit_sum, margins
from parcelscope.plans.pipeline import GOLD_ORDER
from parcelscope.plans.refresh import MONTH, MonthlyFact, changes_between
from parcelscope.plans.silver import Silver
from parcelscope.plans.sketches import COUNTED, distinct_from_sketches, store_sketches
from parcelscope.schemas import MONEY, SPECS
from parcelscope.settings import configure, scratch_dir, staged
from parcelscope.sources.extracts import SchemaDrift
from parcelscope.sources.lake import Lake
from parcelscope.sources.standins import Standins
from parcelscope.streaming.incremental import append_new, stream_files
from parcelscope.streaming.keyed import KeyedStream

SPINE = (date(1995, 1, 1), date(2003, 12, 31))
AS_OF = date(2018, 12, 31)
MARK = date(1998, 6, 30)
RUN_DATE = date(2026, 1, 1)
STATE = "NATION_1"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(fn(configure(spark), folder))

    QUERIES[fn.__name__] = run
    return run


# Whole numbers that may be null: doubles in a query's output, so that every reader of the result
# shows the same values whether or not it has a nullable integer type.
NULLABLE_INTS = {
    "customer_zip_code_prefix",
    "product_photos_qty",
    "review_score",
    "sum_review_score",
    "sum_delivery_days",
    "sum_days_late",
    "delivery_days",
    "days_late",
    "delivery_date_key",
    "estimated_delivery_date_key",
    "late_orders",
    "orders_delivered",
    "total_orders",
    "year",
}


def plain(df: DataFrame) -> DataFrame:
    """Comparable column types: decimals and nullable integers as doubles, dates and times as text."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType) or (
            f.name in NULLABLE_INTS and isinstance(f.dataType, T.IntegralType)
        ):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


def bronze_of(spark: SparkSession, folder: str) -> Callable[[str], DataFrame]:
    return Standins(spark, folder).bronze


def silver_of(spark: SparkSession, folder: str) -> Silver:
    return Silver(bronze_of(spark, folder))


def model_of(spark: SparkSession, folder: str) -> Gold:
    return Gold(silver_of(spark, folder), calendar(spark, *SPINE, AS_OF))


# ingest


def _fresh_lake(spark: SparkSession) -> tuple[Lake, Ledger]:
    """A lake in its own scratch folder and databases."""
    tag = uuid.uuid4().hex
    lake = Lake(spark, scratch_dir(spark, "lake"), prefix=f"ps_{tag}_")
    return lake, Ledger(lake).create()


def _extract(lake: Lake, df: DataFrame, name: str) -> str:
    """Write a table as headed CSV, the form source systems deliver."""
    path = f"{lake.root}/landing/{name}"
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


@query
def in_incremental_orders(spark, folder):
    """Rows after a high-water mark; the range reaches the scan as a pushed filter."""
    return (
        Standins(spark, folder)
        .source("orders")
        .where(after_mark("o_orderdate", MARK))
        .select(
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.to_date("o_orderdate").alias("purchase_date"),
        )
    )


@query
def in_full_load_roundtrip(spark, folder):
    """Extract to CSV, load with drift gate and partitioned refresh, read back."""
    lake, ledger = _fresh_lake(spark)
    source = _extract(lake, bronze_of(spark, folder)("geolocation"), "geolocation")
    full_load(lake, ledger, "geolocation", source, "run-1", RUN_DATE)
    return bronze_table(lake, "geolocation")


@query
def in_incremental_load(spark, folder):
    """Two incremental loads of a growing extract and a rerun of the second: every row once. The
    first extract ends in the middle of a day, and the second brings late rows of the days before."""
    lake, ledger = _fresh_lake(spark)
    orders = bronze_of(spark, folder)("orders")
    before = ~after_mark("order_purchase_timestamp", MARK)
    withheld = (F.to_date("order_purchase_timestamp") >= F.lit(MARK - timedelta(days=3))) & (
        F.pmod(F.col("order_id").cast("long"), F.lit(2)) == 0
    )
    early = _extract(lake, orders.where(before & ~withheld), "orders_1")
    late = _extract(lake, orders, "orders_2")
    for run, source in (("run-1", early), ("run-2", late), ("run-3", late)):
        incremental_load(lake, ledger, "orders", source, run, RUN_DATE)
    return bronze_table(lake, "orders")


@query
def in_same_day_load(spark, folder):
    """Two loads of one extract on one day, in each mode: the second stores nothing and fails nowhere."""
    logs = []
    source = _extract(_fresh_lake(spark)[0], bronze_of(spark, folder)("orders"), "orders")
    for mode in MODES:
        lake, ledger = _fresh_lake(spark)
        for run in ("run-1", "run-2"):
            incremental_load(lake, ledger, "orders", source, run, MARK, mode=mode)
        log = spark.table(lake.name("ops", "run_log")).join(ledger.marks(), "table_name")
        logs.append(log.select(F.lit(mode).alias("mode"), "run_id", "rows_loaded", "status", "last_loaded_date"))
    return reduce(DataFrame.unionAll, logs)


def _damaged_items(items: DataFrame) -> DataFrame:
    """CSV lines of the items: of eleven, one has no number for its price, one is short, one long,
    and one opens a quote that it does not close."""
    fields = [
        F.date_format(c, "yyyy-MM-dd HH:mm:ss") if c == "shipping_limit_date" else F.col(c).cast("string")
        for c in items.columns
    ]
    kind = F.pmod(F.col("order_id").cast("long") + F.col("order_item_id"), F.lit(11))
    line = (
        F.when(kind == 0, F.concat_ws(",", *fields[:5], F.lit("n/a"), fields[6]))
        .when(kind == 1, F.concat_ws(",", *fields[:5]))
        .when(kind == 2, F.concat_ws(",", *fields, F.lit("extra")))
        .when(kind == 3, F.concat(F.concat_ws(",", *fields[:2]), F.lit(',"'), F.concat_ws(",", *fields[2:])))
        .otherwise(F.concat_ws(",", *fields))
    )
    return items.select(line.alias(",".join(items.columns)))


def _load_damaged(spark: SparkSession, folder: str) -> Lake:
    lake, ledger = _fresh_lake(spark)
    path = f"{lake.root}/landing/order_items"
    lines = _damaged_items(bronze_of(spark, folder)("order_items"))
    # one column, written as it is: neither its name nor its text is quoted
    lines.write.option("header", True).option("sep", "\u0001").option("quote", "").csv(path)
    full_load(lake, ledger, "order_items", path, "run-1", RUN_DATE)
    return lake


@query
def in_rescued(spark, folder):
    """What did not read as declared in a damaged extract: line, column and raw value."""
    lake = _load_damaged(spark, folder)
    return rescued(lake, "order_items").select("run_id", "order_id", "order_item_id", "line", "column", "raw_value")


@query
def in_damaged_load(spark, folder):
    """The bronze rows of a damaged extract: a row per line, with nulls for what did not read."""
    items = bronze_table(_load_damaged(spark, folder), "order_items")
    return items.select("order_id", "order_item_id", "seller_id", "shipping_limit_date", "price", "freight_value")


@query
def in_rejects(spark, folder):
    """Rows without an event time or dated after the run are kept apart, once."""
    lake, ledger = _fresh_lake(spark)
    source = _extract(lake, bronze_of(spark, folder)("orders"), "orders")
    for run in ("run-1", "run-2"):
        incremental_load(lake, ledger, "orders", source, run, MARK)
    return rejects(lake, "orders").select("order_id", "order_purchase_timestamp", "reason")


@query
def in_run_report(spark, folder):
    """The numbered run report after loads of three tables, one after the other."""
    lake, ledger = _fresh_lake(spark)
    bronze = bronze_of(spark, folder)
    for table in ("sellers", "products", "product_category_translation"):
        full_load(lake, ledger, table, _extract(lake, bronze(table), table), "run-1", RUN_DATE)
    return ledger.runs().select("sequence", "table_name", "rows_loaded", "status")


@query
def in_run_log(spark, folder):
    """Run log and marks after loading four tables."""
    lake, ledger = _fresh_lake(spark)
    bronze = bronze_of(spark, folder)
    for table in ("sellers", "products", "product_category_translation"):
        full_load(lake, ledger, table, _extract(lake, bronze(table), table), "run-1", RUN_DATE)
    reviews = _extract(lake, bronze("order_reviews"), "order_reviews")
    incremental_load(lake, ledger, "order_reviews", reviews, "run-1", RUN_DATE)
    return ledger.runs().join(ledger.marks(), "table_name").drop("run_timestamp", "sequence")


@query
def in_schema_drift(spark, folder):
    """A drifted second extract is refused and logged; the rows of the first load stay."""
    lake, ledger = _fresh_lake(spark)
    sellers = bronze_of(spark, folder)("sellers")
    full_load(lake, ledger, "sellers", _extract(lake, sellers, "sellers_1"), "run-1", RUN_DATE)
    drifted = sellers.withColumnRenamed("seller_city", "city's name")
    try:
        full_load(lake, ledger, "sellers", _extract(lake, drifted, "sellers_2"), "run-2", RUN_DATE)
    except SchemaDrift:
        pass
    log = spark.table(lake.name("ops", "run_log")).where(F.col("status") == "schema_drift")
    refused = log.agg(F.max("error_message")).scalar()
    return bronze_table(lake, "sellers").select(
        "seller_id", "seller_state", refused.alias("refused")
    )


@query
def st_incremental_events(spark, folder):
    """The events file streamed twice through one checkpoint; the second run adds nothing."""
    base = scratch_dir(spark, "stream")
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    for _ in range(2):
        # a glob that matches the one file: a file source takes folders or patterns
        events = stream_files(spark, f"{folder}/events.parque[t]", schema)
        append_new(events, f"{base}/events", f"{base}/checkpoint")
    stored = spark.read.schema(schema).parquet(f"{base}/events")
    return stored.select("event_id", "ts", "user_id", "event_type", "value")


@query
def st_keyed_orders(spark, folder):
    """Orders in three arrivals through a keyed stream: the second repeats a month of the first and brings
    what was held back of it, the third brings old orders, which are late; then a run with nothing new."""
    base = scratch_dir(spark, "keyed")
    orders = bronze_of(spark, folder)("orders").select("order_id", "order_purchase_timestamp")
    number, day = F.col("order_id").cast("long"), F.to_date("order_purchase_timestamp")
    old = (F.pmod(number, F.lit(10)) == 3) & (day < F.lit(date(1993, 1, 1)))
    december = day.between(date(1996, 12, 1), date(1996, 12, 31))
    held = december & (F.pmod(number, F.lit(5)) == 0)
    first, second = day <= F.lit(date(1996, 12, 31)), day <= F.lit(date(1998, 3, 31))
    arrivals = [first & ~old & ~held, (~first & second) | december, day.isNull() | ~second | old]
    keyed = KeyedStream(spark, f"{base}/orders", orders.schema, ("order_id",), "order_purchase_timestamp", 45)
    for n, arrived in enumerate(arrivals):
        orders.where(arrived).write.parquet(f"{base}/landing/{n}")
        keyed.take(stream_files(spark, f"{base}/landing/*", orders.schema))
    keyed.take(stream_files(spark, f"{base}/landing/*", orders.schema))
    return keyed.rows().withColumn("reason", F.lit("stored")).unionByName(keyed.late())


# silver


def _silver_query(table: str, name: str | None = None) -> None:
    def run(spark, folder):
        return silver_of(spark, folder)[table]

    run.__name__ = name or f"sv_{table}"
    run.__doc__ = f"silver.{table}"
    query(run)


for _table in (
    "orders",
    "order_items",
    "order_payments",
    "order_reviews",
    "customers",
    "sellers",
    "products",
):
    _silver_query(_table)


@query
def sv_geolocation(spark, folder):
    return rounded(
        silver_of(spark, folder)["geolocation"], "geolocation_lat", "geolocation_lng"
    )


@query
def sv_managed_geolocation(spark, folder):
    """Geolocation as a managed table, written twice and read back by name."""
    lake, _ = _fresh_lake(spark)
    places = silver_of(spark, folder)["geolocation"]
    lake.save_managed(places.limit(1), "silver", "geolocation")
    return rounded(lake.save_managed(places, "silver", "geolocation"), "geolocation_lat", "geolocation_lng")


@query
def sv_stored_tables(spark, folder):
    """Silver customers through the lake: refreshed twice, read by name."""
    lake, _ = _fresh_lake(spark)
    customers = silver_of(spark, folder)["customers"]
    for df in (customers.limit(5), customers):
        lake.refresh(df, "silver", "customers")
    return lake.table("silver", "customers")


# gold


def _refreshed_gold(spark: SparkSession, folder: str) -> Lake:
    """A lake whose five gold tables were each refreshed twice, first by a few rows."""
    lake, _ = _fresh_lake(spark)
    model = model_of(spark, folder)
    for table in GOLD_ORDER:
        # the fact's keys are hashed after staging: its rows are a third as long without them
        stored = gold.keyed(staged(model.rows(), table)) if table == "fact_orders" else staged(model[table], table)
        for df in (stored.limit(3), stored):
            lake.refresh(df, "gold", table)
    return lake


@query
def gd_refreshed_rows(spark, folder):
    """The rows of the five gold tables after two refreshes, each under its table, key and two values."""
    lake = _refreshed_gold(spark, folder)
    shown = {
        "dim_date": ("date_key", "full_date", "year"),
        "dim_customers": ("customer_key", "customer_city", "customer_state"),
        "dim_sellers": ("seller_key", "seller_city", "total_orders"),
        "dim_products": ("product_key", "product_category_english", "product_weight_g"),
        "fact_orders": ("order_item_key", "order_id", "payment_value"),
    }
    names = ("row_key", "first_value", "second_value")
    rows = [
        lake.table("gold", t).select(
            F.lit(t).alias("table_name"), *[F.col(c).cast("string").alias(n) for c, n in zip(columns, names)]
        )
        for t, columns in shown.items()
    ]
    return reduce(DataFrame.unionAll, rows)


@query
def gd_full_refresh(spark, folder):
    """The five gold tables refreshed twice, counted by name."""
    lake = _refreshed_gold(spark, folder)
    counts = [
        lake.table("gold", t).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for t in GOLD_ORDER
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def gd_dim_date(spark, folder):
    """The calendar of every year in which an order was placed, delivered or due."""
    columns = [
        "order_purchase_timestamp",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ]
    return calendar_over(bronze_of(spark, folder)("orders"), columns, AS_OF)


@query
def gd_dim_customers(spark, folder):
    return rounded(
        model_of(spark, folder)["dim_customers"], "geolocation_lat", "geolocation_lng"
    )


@query
def gd_seller_stats(spark, folder):
    s = silver_of(spark, folder)
    stats = gold.seller_stats(s["order_items"], s["orders"], s["order_reviews"])
    return rounded(stats, "on_time_rate", "avg_review_score")


@query
def gd_dim_sellers(spark, folder):
    return rounded(
        model_of(spark, folder)["dim_sellers"],
        "geolocation_lat",
        "geolocation_lng",
        "on_time_rate",
        "avg_review_score",
    )


@query
def gd_dim_products(spark, folder):
    return model_of(spark, folder)["dim_products"]


@query
def gd_latest_review(spark, folder):
    return gold.latest_review(silver_of(spark, folder)["order_reviews"])


@query
def gd_payments_agg(spark, folder):
    return gold.payments_agg(silver_of(spark, folder)["order_payments"])


@query
def gd_customer_lookup(spark, folder):
    return gold.customer_lookup(silver_of(spark, folder)["customers"])


@query
def gd_geo_by_zip(spark, folder):
    places = gold.geo_by_zip(silver_of(spark, folder)["geolocation"])
    return rounded(places, "geolocation_lat", "geolocation_lng")


@query
def gd_fact_orders(spark, folder):
    return model_of(spark, folder)["fact_orders"]


def _grown_silver(silver: Mapping[str, DataFrame], step: int) -> dict[str, DataFrame]:
    """Silver after each of three loads: orders up to a day, later ones and some reviews and sellers
    missing at first."""
    until = [date(1994, 12, 31), date(1997, 3, 15), date(9999, 1, 1)][step]
    some_reviews = F.pmod(F.col("review_id").cast("long"), F.lit(1000)) != 17
    some_sellers = F.pmod(F.col("seller_id").cast("long"), F.lit(7)) != 3
    return {
        **silver,
        "orders": silver["orders"].where(~after_mark("order_purchase_timestamp", until)),
        "order_reviews": silver["order_reviews"].where(some_reviews) if step < 2 else silver["order_reviews"],
        "sellers": silver["sellers"].where(some_sellers) if step == 0 else silver["sellers"],
    }


@query
def gd_fact_incremental(spark, folder):
    """The fact by month after a first build and two refreshes of the months that changed."""
    lake, _ = _fresh_lake(spark)
    fact, source = MonthlyFact(lake), silver_of(spark, folder)
    silver = {t: staged(source[t], t) for t in source}  # stored, as a warehouse has it
    dates = calendar(spark, *SPINE, AS_OF)
    before = _grown_silver(silver, 0)
    fact.rebuild(Gold(before, dates)["fact_orders"])
    for step in (1, 2):
        after = _grown_silver(silver, step)
        fact.refresh(after, Gold(after, dates), changes_between(before, after))
        before = after
    return fact.read().drop(MONTH)


@query
def rl_pruned(spark, folder):
    """Revenue of one year and one seller state from the fact stored by month: only that year's files
    are read."""
    lake, _ = _fresh_lake(spark)
    fact = MonthlyFact(lake)
    model = model_of(spark, folder)
    fact.rebuild(model["fact_orders"])
    stored = {**{t: model[t] for t in model if t != "fact_orders"}, "fact_orders": fact.read()}
    measures = ["total_revenue", "total_orders", "on_time_rate"]
    found = evaluate(stored, measures, ["dim_date.year"], {"dim_date.year": 1996}, Role.seller(STATE))
    return rounded(found, "on_time_rate")


# Snapshots of the customers in the order in which they come in: a late one, and one that comes twice.
SNAPSHOT_DAYS = [date(1994, 12, 31), date(1996, 12, 31), date(1998, 12, 31), date(1995, 12, 31), date(1996, 12, 31)]
PERSON, TRAITS = "customer_unique_id", ["customer_city", "customer_state"]


def _customer_history(spark: SparkSession, folder: str) -> DataFrame:
    """The customers known on each snapshot day, with the attributes they then had, as a history."""
    lake, _ = _fresh_lake(spark)
    s = silver_of(spark, folder)
    bought = s["orders"].select("customer_id", F.to_date("order_purchase_timestamp").alias("day"))
    dated = staged(s["customers"].join(bought, "customer_id"), "dated_customers")
    for day in SNAPSHOT_DAYS:
        known = latest_per_key(dated.where(F.col("day") <= F.lit(day)), [PERSON], [F.col("customer_id")], TRAITS)
        found = apply_snapshot(lake, "dim_customers_history", known, day, PERSON, TRAITS)
    return found


@query
def gd_dim_customers_history(spark, folder):
    """Versions of the customers over four snapshots, one of them late and one taken in twice."""
    found = _customer_history(spark, folder)
    return found.select(
        F.col("member_key").alias("customer_key"), PERSON, *TRAITS,
        "effective_start_date", "effective_end_date", "is_current",
    )


@query
def gd_fact_asof(spark, folder):
    """The fact with its customers as they were on the day of the order; null before the first snapshot."""
    # stored under natural ids: the look for hot customers and the join read it, and no hashed key is moved
    rows = model_of(spark, folder).rows().select(
        *gold.ITEM_IDENTITY, "seller_id", PERSON,
        F.to_date(F.col("order_date_key").cast("string"), "yyyyMMdd").alias("order_date"), F.col("price").cast(MONEY),
    )
    fact, versions = staged(rows, "fact_rows"), _customer_history(spark, folder)
    identity = [*gold.ITEM_IDENTITY, "seller_id"]
    found = as_of_join(fact, versions, PERSON, "order_date", [*TRAITS, "effective_start_date"], identity)
    return found.select(
        "order_id", gold.surrogate_key(F.col("order_id"), F.col("order_item_id")).alias("order_item_key"),
        gold.surrogate_key(F.col(PERSON)).alias("member_key"), "order_date", "price", *TRAITS, "effective_start_date",
    )


# quality


def _expected_counts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Row counts of the provided tables that the bronze tables are made from."""
    standins = Standins(spark, folder)
    counted = {
        "orders": "orders",
        "order_items": "lineitem",
        "order_payments": "orders",
        "order_reviews": "events",
        "customers": "orders",
        "sellers": "supplier",
        "products": "part",
        "product_category_translation": "nation",
        "geolocation": "customer",
    }
    return {t: standins.source(s).groupBy().count() for t, s in counted.items()}


@query
def qc_bronze(spark, folder):
    """Bronze checks; the expected counts are those of the provided source tables."""
    bronze = bronze_of(spark, folder)
    return quality.bronze_suite({t: bronze(t) for t in SPECS}, _expected_counts(spark, folder))


@query
def qc_from_footers(spark, folder):
    """The bronze checks on stored tables, with counts and nulls from the files' footers."""
    lake, _ = _fresh_lake(spark)
    bronze = bronze_of(spark, folder)
    for t in SPECS:
        lake.overwrite(bronze(t), "bronze", t)
    return suite_from_footers(spark, {t: lake.path("bronze", t) for t in SPECS}, _expected_counts(spark, folder))


@query
def qc_silver(spark, folder):
    return _silver_checks_of(spark, folder)


@query
def qc_gold(spark, folder):
    """Gold checks on a stored fact, as the warehouse runs them."""
    model = model_of(spark, folder)
    tables = {t: model[t] for t in model}
    tables["fact_orders"] = staged(tables["fact_orders"], "fact_orders")
    return quality.gold_suite(tables, model.silver)


@query
def qc_summary(spark, folder):
    """Passed and failed silver checks."""
    return quality.summary(qc_silver(spark, folder))


@query
def qc_lengths(spark, folder):
    """Declared text lengths of the dimensions."""
    return quality.length_suite(model_of(spark, folder))


@query
def qc_unique_item_key(spark, folder):
    """Repeats of (order, item) among items, by natural parts and by hashed key, with separator."""
    items = silver_of(spark, folder)["order_items"]
    keyed = items.select(
        gold.surrogate_key(F.col("order_id"), F.col("order_item_id"), sep="|").alias("item_key")
    )
    return quality.unique_keys(keyed, "order_items", "item_key")


def _silver_checks_of(spark, folder) -> DataFrame:
    bronze = bronze_of(spark, folder)
    silver = Silver(bronze)
    counts = {t: bronze(t).groupBy().count() for t in silver if t != "geolocation"}
    return quality.silver_suite({t: silver[t] for t in silver}, counts)


@query
def qc_failures(spark, folder):
    """The failed checks of the silver suite and of the item keys, one row each."""
    suite = _silver_checks_of(spark, folder).unionByName(QUERIES["qc_unique_item_key"](spark, folder))
    return quality.failures(suite)


@query
def qc_logged(spark, folder):
    """Two suites in the quality log; what is returned is the second run's rows alone."""
    _, ledger = _fresh_lake(spark)
    ledger.log_quality(QUERIES["qc_unique_item_key"](spark, folder))
    return ledger.log_quality(_silver_checks_of(spark, folder)).drop("run_timestamp", "run_id")


# measures


@query
def me_revenue_by_year_state(spark, folder):
    """The flagship: revenue, orders and on-time rate by order year and customer state."""
    result = evaluate(
        model_of(spark, folder),
        ["total_revenue", "total_orders", "on_time_rate"],
        by=["dim_date.year", "dim_customers.customer_state"],
    )
    return rounded(result, "on_time_rate")


@query
def me_totals(spark, folder):
    """The unfiltered totals of every order-family measure."""
    result = evaluate(
        model_of(spark, folder),
        ["total_revenue", "total_orders", "late_orders", "total_customers", "avg_order_value"],
    )
    return rounded(result, "avg_order_value")


@query
def me_delivery_by_state(spark, folder):
    measures = [
        "on_time_rate",
        "on_time_rate_delivered",
        "late_orders",
        "avg_delivery_days",
        "avg_days_late",
    ]
    result = evaluate(
        model_of(spark, folder), measures, by=["dim_customers.customer_state"]
    )
    return rounded(result, *[m for m in measures if m != "late_orders"])


@query
def me_reviews_by_category(spark, folder):
    result = evaluate(
        model_of(spark, folder),
        ["avg_review_score"],
        by=["dim_products.product_category_english"],
    )
    return rounded(result, "avg_review_score")


@query
def me_review_rolling_3m(spark, folder):
    result = evaluate(
        model_of(spark, folder),
        ["review_score_rolling_3m"],
        by=["dim_date.year", "dim_date.month"],
    )
    return rounded(result, "review_score_rolling_3m")


@query
def me_review_rolling_daily(spark, folder):
    """The trailing three months' score on every day, by state."""
    result = evaluate(
        model_of(spark, folder),
        ["review_score_rolling_3m"],
        by=["dim_date.full_date", "dim_customers.customer_state"],
    )
    return rounded(result, "review_score_rolling_3m")


@query
def me_margins(spark, folder):
    """Totals by year, state, category, two pairs of them and over all, in one pass over the fact."""
    year, state, category = "dim_date.year", "dim_customers.customer_state", "dim_products.product_category_english"
    rates = ["on_time_rate", "avg_review_score", "repeat_customer_rate", "clv"]
    result = margins(
        model_of(spark, folder),
        ["total_revenue", "total_orders", "total_customers", *rates],
        [[year], [state], [category], [year, state], [state, category], []],
    )
    return rounded(result, *rates)


@query
def me_distinct_from_sketches(spark, folder):
    """Orders and customers by year and state from stored sketches; the fact is not read again."""
    lake, _ = _fresh_lake(spark)
    model = model_of(spark, folder)
    stored = store_sketches(lake, model)
    return distinct_from_sketches(
        stored, model["dim_date"], list(COUNTED), ["dim_date.year", "dim_customers.customer_state"]
    )


@query
def me_revenue_yoy(spark, folder):
    result = evaluate(
        model_of(spark, folder),
        ["total_revenue", "yoy_revenue", "yoy_revenue_pct"],
        by=["dim_date.year", "dim_date.month"],
    )
    return rounded(result, "yoy_revenue_pct")


@query
def me_customers(spark, folder):
    result = evaluate(
        model_of(spark, folder),
        [
            "total_customers",
            "repeat_customer_rate",
            "repeat_customer_rate_orders",
            "clv",
            "avg_order_value",
        ],
        by=["dim_customers.customer_state"],
    )
    return rounded(
        result, "repeat_customer_rate", "repeat_customer_rate_orders", "clv", "avg_order_value"
    )


@query
def me_seller_sla(spark, folder):
    result = evaluate(
        model_of(spark, folder), ["seller_sla"], by=["dim_sellers.seller_id"]
    )
    return rounded(result, "seller_sla")


@query
def me_orders_delivered(spark, folder):
    """Orders by the year they were delivered, next to orders by the year they were placed."""
    return evaluate(
        model_of(spark, folder), ["orders_delivered", "total_orders"], by=["dim_date.year"]
    )


@query
def me_implicit_sums(spark, folder):
    return evaluate(
        model_of(spark, folder),
        [implicit_sum(c) for c in SUMMABLE],
        by=["dim_sellers.seller_state"],
    )


@query
def me_revenue_by_category_filtered(spark, folder):
    """Revenue by category under filters on the calendar, the fact and the customers."""
    return evaluate(
        model_of(spark, folder),
        ["total_revenue", "total_orders"],
        by=["dim_products.product_category_english"],
        where={
            "dim_date.year": [1996, 1997],
            "fact_orders.is_delivered": 1,
            "dim_customers.customer_state": lambda c: c != STATE,
        },
    )


@query
def rl_seller(spark, folder):
    result = evaluate(
        model_of(spark, folder),
        ["total_revenue", "total_orders", "on_time_rate"],
        by=["dim_date.year"],
        role=Role.seller(STATE),
    )
    return rounded(result, "on_time_rate")


@query
def rl_region(spark, folder):
    result = evaluate(
        model_of(spark, folder),
        ["total_revenue", "total_orders", "on_time_rate"],
        by=["dim_date.year", "dim_customers.customer_state"],
        role=Role.region(STATE),
    )
    return rounded(result, "on_time_rate")


# analyses


@query
def an_lag_vs_score(spark, folder):
    result = analyses.lag_vs_score(model_of(spark, folder)["fact_orders"])
    return rounded(result, "avg_review_score", "lag_score_corr")


@query
def an_delay_by_state(spark, folder):
    return rounded(analyses.delay_by_state(model_of(spark, folder)), "delay_rate", "avg_days_late")


@query
def an_seller_concentration(spark, folder):
    result = analyses.seller_concentration(model_of(spark, folder)["fact_orders"])
    return rounded(result, "cum_seller_share", "cum_late_share")
