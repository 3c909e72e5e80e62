"""The fact by order month: pruned reads, and refreshes that rewrite only the months that changed.

A change in any silver table is followed to the orders it touches, those to the months they lie or lay
in, and these months are built again from silver and replaced, partition by partition. A rewritten
month depends on silver alone, so a refresh that died half-way is simply run again with the same
changes.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from parcelscope.functions.dates import date_key
from parcelscope.plans.gold import fact_rows, keyed
from parcelscope.schemas import DATETIME, GOLD
from parcelscope.sources.lake import Lake

LAYER, TABLE = "gold", "fact_orders_by_month"
# The partition column: year and month of the order, as in 199803.
MONTH = "order_month"
UNDATED = 0

# Tables are compared by this many ranges of hashed keys first, from 16 rows a range on.
RANGES = 1 << 16

# The column of each silver table by which its changes reach orders.
CHANGE_KEYS = {
    "orders": "order_id",
    "order_items": "order_id",
    "order_payments": "order_id",
    "order_reviews": "order_id",
    "customers": "customer_id",
    "sellers": "seller_id",
    "products": "product_id",
}


def month_of(key: Column) -> Column:
    """The month of a ``yyyymmdd`` date key; undated rows have a month of their own."""
    return F.coalesce(F.floor(key / 100).cast("int"), F.lit(UNDATED))


def changed_keys(before: DataFrame, after: DataFrame, key: str, ranges: int = RANGES) -> DataFrame:
    """The distinct keys whose rows differ between two states, as multisets; a null key is a key.

    Each state adds up the hashes of its rows per key, one with the other sign, so both meet in a
    single algebraic aggregate and a key with many rows sends one row per task.

    Most of a large table is usually the same in both states, so the sums are first made per range of
    hashed keys, which leaves few rows to shuffle, and only the keys of ranges that differ are told
    apart. A short table, and one whose number of rows says that most ranges differ, goes by its keys
    at once. Both states are read more than once and should be stored.
    """
    held = before.count(), after.count()
    if max(held) >= 16 * ranges and abs(held[0] - held[1]) <= ranges:
        part = F.pmod(F.xxhash64(key), F.lit(ranges)).cast("int").alias("_range")
        differ = _unequal(before, after, part, "_range").collect()
        if not differ:
            return before.select(key).limit(0)
        if len(differ) <= ranges // 2:
            listed = F.broadcast(before.sparkSession.createDataFrame(differ, "_range int"))
            before, after = (df.withColumn("_range", part).join(listed, "_range", "left_semi").drop("_range") for df in (before, after))
    return _unequal(before, after, F.col(key), key)


def _unequal(before: DataFrame, after: DataFrame, group: Column, name: str) -> DataFrame:
    """The groups whose sums of row hashes or numbers of rows differ, as a column ``name``."""

    def signed(df: DataFrame, sign: int) -> DataFrame:
        row = df.select(group.alias(name), F.xxhash64(*sorted(df.columns)).alias("_row"))
        # halves, whose sums stay whole numbers of 64 bits
        high, low = F.shiftright("_row", 32) * sign, F.col("_row").bitwiseAND(F.lit(0xFFFFFFFF)) * sign
        return row.select(name, high.alias("_high"), low.alias("_low"), F.lit(sign).alias("_n"))

    both = signed(before, -1).unionByName(signed(after, 1))
    sums = both.groupBy(name).agg(*[F.sum(c).alias(c) for c in ("_high", "_low", "_n")])
    return sums.where("_high <> 0 OR _low <> 0 OR _n <> 0").select(name)


def changes_between(before: Mapping[str, DataFrame], after: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Changed keys of every silver table that the fact is made from. Of sellers and products the fact
    asks only whether they are there."""
    changes = {}
    for table, key in CHANGE_KEYS.items():
        old, new = before[table], after[table]
        if table in ("sellers", "products"):
            old, new = old.select(key), new.select(key)
        changes[table] = changed_keys(old, new, key)
    return changes


def touched_orders(silver: Mapping[str, DataFrame], changes: Mapping[str, DataFrame]) -> DataFrame:
    """The distinct ids of the orders that changes in any table touch."""
    found = []
    for table, keys in changes.items():
        if CHANGE_KEYS[table] == "order_id":
            found.append(keys)
        else:
            carrier = silver["orders" if table == "customers" else "order_items"]
            column = CHANGE_KEYS[table]
            found.append(carrier.select("order_id", column).join(keys, column, "left_semi").select("order_id"))
    return reduce(DataFrame.unionAll, found).distinct()


def _bought_in(months: list[int]) -> Column:
    """Orders of these months, as ranges on the bare column, which sources can push down; months in a
    row are one range."""
    tests, dated = [], sorted(m for m in months if m != UNDATED)
    if UNDATED in months:
        tests.append(F.col("order_purchase_timestamp").isNull())
    for first, end in _runs(dated):
        low, high = (F.lit(datetime(m // 100, m % 100, 1)).cast(DATETIME) for m in (first, end))
        tests.append((F.col("order_purchase_timestamp") >= low) & (F.col("order_purchase_timestamp") < high))
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _runs(months: list[int]) -> Iterator[tuple[int, int]]:
    """First month, and month after the last, of each run of consecutive months."""
    start = None
    for at, month in enumerate(months):
        start = month if start is None else start
        after = month + 1 if month % 100 < 12 else month + 89
        if at + 1 == len(months) or months[at + 1] != after:
            yield start, after
            start = None


class MonthlyFact:
    """The fact of one lake, stored by order month."""

    def __init__(self, lake: Lake, table: str = TABLE):
        self.lake, self.table = lake, table

    def read(self) -> DataFrame:
        """The fact with its month as one more column, by which readers are pruned."""
        return self.lake.table(LAYER, self.table)

    def rebuild(self, fact: DataFrame) -> None:
        self._write(self._laid_out(fact), "static")

    def refresh(
        self, silver: Mapping[str, DataFrame], dims: Mapping[str, DataFrame], changes: Mapping[str, DataFrame]
    ) -> list[int]:
        """Bring the stored fact up to ``silver`` after ``changes``; returns the months written anew.

        The lists of months and of ranges of keys are all that reaches the driver. Orders are filtered
        by time before anything else, items meet the orders that are left, and dimensions must be those
        that go with ``silver``.
        """
        touched = touched_orders(silver, changes)
        bought = silver["orders"].select("order_id", month_of(date_key(F.col("order_purchase_timestamp"))).alias(MONTH))
        stored = self.read().select("order_id", MONTH)
        both = bought.unionByName(stored).join(touched, "order_id", "left_semi")
        months = sorted(row[MONTH] for row in both.select(MONTH).distinct().collect())
        if not months:
            return []
        wanted = {**silver, "orders": silver["orders"].where(_bought_in(months))}
        fresh, written = self._laid_out(keyed(fact_rows(wanted, dims))), Observation()
        self._write(fresh.observe(written, F.collect_set(MONTH).alias("months")), "dynamic")
        filled = set(written.get["months"])
        for month in months:
            if month not in filled:
                self._empty(month)
        return months

    def _laid_out(self, fact: DataFrame) -> DataFrame:
        return fact.withColumn(MONTH, month_of(F.col("order_date_key")))

    def _write(self, rows: DataFrame, mode: str) -> None:
        path = self.lake.path(LAYER, self.table)
        writer = rows.write.format(self.lake.fmt).mode("overwrite").option("partitionOverwriteMode", mode)
        writer.partitionBy(MONTH).save(path)
        spark, name = self.lake.spark, self.lake.name(LAYER, self.table)
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {self.lake.fmt} "
            f"PARTITIONED BY ({MONTH}) LOCATION '{path}'"
        )
        spark.catalog.recoverPartitions(name)
        spark.catalog.refreshTable(name)

    def _empty(self, month: int) -> None:
        """Replace a month by no rows, which a dynamic overwrite cannot say."""
        none = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()})" for f in GOLD["fact_orders"].fields)
        name = self.lake.name(LAYER, self.table)
        self.lake.spark.sql(
            f"INSERT OVERWRITE TABLE {name} PARTITION ({MONTH} = {month}) SELECT {none} FROM VALUES (1) WHERE false"
        )
