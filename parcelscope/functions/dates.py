"""Date and calendar columns."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_days(start: Column, end: Column) -> Column:
    """Whole 24-hour periods from ``start`` to ``end``, truncated toward zero; null if either is.

    A day-time interval's day part, so 36 hours is 1 day however many midnights lie between.
    """
    return F.extract(F.lit("DAY"), end - start).cast("long")


def date_key(ts: Column) -> Column:
    """Integer YYYYMMDD, null for null."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def us_week(d: Column) -> Column:
    """Week of year where week 1 holds January 1 and weeks start on Sunday."""
    first_weekday = F.dayofweek(F.trunc(d, "YYYY"))
    return F.floor((F.dayofyear(d) + first_weekday - 2) / 7) + 1


def calendar_columns(d: Column, as_of: date) -> list[Column]:
    """The attributes of one calendar day, in table order."""
    weekday = F.dayofweek(d)
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).cast("smallint").alias("year"),
        F.quarter(d).cast("smallint").alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d)).alias("quarter_name"),
        F.month(d).cast("smallint").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM-yyyy").alias("month_year"),
        us_week(d).cast("smallint").alias("week_of_year"),
        F.dayofmonth(d).cast("smallint").alias("day_of_month"),
        weekday.cast("smallint").alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        weekday.isin(1, 7).alias("is_weekend"),
        (d == F.last_day(d)).alias("is_month_end"),
        (F.year(d) - F.lit(as_of.year)).cast("smallint").alias("year_offset"),
    ]
