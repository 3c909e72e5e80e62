"""The generated calendar."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelscope.functions.dates import calendar_columns


def calendar(spark: SparkSession, start: date, end: date, as_of: date) -> DataFrame:
    """One row per day from ``start`` to ``end``; ``as_of`` fixes the year offset."""
    day = F.explode(F.sequence(F.lit(start), F.lit(end)))
    return spark.range(1).select(day.alias("d")).select(*calendar_columns(F.col("d"), as_of))


def calendar_over(dates: DataFrame, columns: list[str], as_of: date) -> DataFrame:
    """The calendar of every whole year touched by the given date or timestamp columns."""
    lows = [F.min(c).alias(f"lo_{c}") for c in columns]
    highs = [F.max(c).alias(f"hi_{c}") for c in columns]
    bounds = dates.agg(*lows, *highs)
    first = F.array_min(F.array(*[f"lo_{c}" for c in columns])).cast("date")
    last = F.array_max(F.array(*[f"hi_{c}" for c in columns])).cast("date")
    start = F.trunc(first, "YYYY")
    end = F.date_sub(F.add_months(F.trunc(last, "YYYY"), 12), 1)
    return bounds.select(F.explode(F.sequence(start, end)).alias("d")).select(
        *calendar_columns(F.col("d"), as_of)
    )
