"""The batch pipeline over a lake: bronze to silver to gold, and the checks of each layer."""

from __future__ import annotations

from pyspark.sql import DataFrame

from parcelscope.plans.control import Ledger
from parcelscope.plans.gold import Gold
from parcelscope.plans.ingest import bronze_table
from parcelscope.plans.quality import bronze_suite, gold_suite, silver_suite
from parcelscope.plans.silver import Silver
from parcelscope.schemas import GOLD, SPECS
from parcelscope.sources.lake import Lake

# Dimensions first: the fact keeps only items whose keys they hold.
GOLD_ORDER = ("dim_date", "dim_customers", "dim_sellers", "dim_products", "fact_orders")


class Stored:
    """Tables of one layer, read from the catalog."""

    def __init__(self, lake: Lake, layer: str, names):
        self.lake, self.layer, self.names = lake, layer, tuple(names)

    def __getitem__(self, table: str) -> DataFrame:
        return self.lake.table(self.layer, table)

    def __iter__(self):
        return iter(self.names)


def build_silver(lake: Lake) -> Stored:
    silver = Silver(lambda table: bronze_table(lake, table))
    for table in silver:
        lake.refresh(silver[table], "silver", table)
    return Stored(lake, "silver", silver)


def build_gold(lake: Lake, dates: DataFrame) -> Stored:
    """Full refresh of the star schema; the fact reads the stored dimensions."""
    stored = Stored(lake, "gold", GOLD)
    plans = Gold(Stored(lake, "silver", ()), dates)
    for table in GOLD_ORDER:
        source = plans[table] if table != "fact_orders" else plans.fact(stored)
        lake.refresh(source, "gold", table)
    return stored


def check_bronze(lake: Lake, ledger: Ledger, expected: dict[str, int]) -> DataFrame:
    tables = {t: bronze_table(lake, t) for t in SPECS}
    return ledger.log_quality(bronze_suite(tables, expected))


def check_silver(lake: Lake, ledger: Ledger) -> DataFrame:
    silver = Stored(lake, "silver", [t for t in SPECS if t != "product_category_translation"])
    counts = {t: bronze_table(lake, t).groupBy().count() for t in silver if t != "geolocation"}
    return ledger.log_quality(silver_suite(_as_dict(silver), counts))


def check_gold(lake: Lake, ledger: Ledger) -> DataFrame:
    gold = _as_dict(Stored(lake, "gold", GOLD))
    silver = _as_dict(Stored(lake, "silver", ("order_items", "order_payments")))
    return ledger.log_quality(gold_suite(gold, silver))


def _as_dict(stored: Stored) -> dict[str, DataFrame]:
    return {t: stored[t] for t in stored}
