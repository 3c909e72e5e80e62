"""Date sets shifted in time, built on the calendar table.

What they make of days is bounded by the calendar's length, whatever the size of the fact table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def trailing_months(
    daily: DataFrame, group: list[str], day: str, sums: list[str], ends: DataFrame, months: int
) -> DataFrame:
    """``sums`` of the ``months`` months up to each of the days ``ends``, per ``group``.

    ``daily`` has one row per group and day with something on it, ``ends`` a column ``last`` and more
    columns, which the result keeps. A window starts ``months`` months before the day after its last
    one, so it covers whole months when that is a month end. Groups without a day in a window have no
    row for it; a null adds nothing.

    Each group's days are filled up with running sums, and a window is the difference of two of them,
    as many days apart as it is long. So a day is one row, however many windows it lies in, and the
    rows of a group are bounded by the calendar.
    """
    calendar_order = W.partitionBy(*group).orderBy(day)
    until_now = calendar_order.rowsBetween(W.unboundedPreceding, 0)
    # months of 28 to 31 days
    longest = 31 * months
    last = F.coalesce(F.date_sub(F.lead(day).over(calendar_order), 1), F.date_add(day, longest))
    running = daily.select(
        *group, day, last.alias("_until"),
        F.count(F.lit(1)).over(until_now).alias("_days"), *[F.sum(c).over(until_now).alias(c) for c in sums],
    )
    filled = running.withColumn("last", F.explode(F.sequence(day, "_until"))).drop(day, "_until")
    after = F.date_add("last", 1)
    length = F.datediff(after, F.add_months(after, -months))
    in_order = W.partitionBy(*group).orderBy("last")

    def in_window(c: str) -> Column:
        # the running sum on the day before the window, a number of rows back that its length tells
        at = [F.when(length == n, F.lag(c, n).over(in_order)) for n in range(28 * months, longest + 1)]
        return F.coalesce(F.col(c), F.lit(0)) - F.coalesce(*at, F.lit(0))

    windowed = filled.select(*group, "last", in_window("_days").alias("_days"), *[in_window(c).alias(c) for c in sums])
    # one row per group and day at most: nothing is multiplied
    found = windowed.where("_days > 0").join(F.broadcast(ends), "last")
    return found.select(*group, *[c for c in ends.columns if c != "last"], *sums)


def same_days_last_year(days: DataFrame, calendar: DataFrame, group: list[str]) -> DataFrame:
    """Per group of ``days``: the matching calendar days one year earlier.

    Each day moves back twelve months (29 to 28 February). A complete 28-day February also takes
    in the 29th when the earlier year has one, so months, quarters and years compare whole.
    """
    month = W.partitionBy(*group, F.trunc("full_date", "MM"))
    shifted = F.add_months("full_date", -12)
    complete_february = (
        (F.date_format("full_date", "MM-dd") == "02-28")
        & (F.col("_days") == 28)
        & (F.dayofmonth(F.last_day(shifted)) == 29)
    )
    earlier = F.when(complete_february, F.array(shifted, F.date_add(shifted, 1))).otherwise(
        F.array(shifted)
    )
    return (
        days.select(*group, "full_date")
        .distinct()
        .withColumn("_days", F.count(F.lit(1)).over(month))
        .select(*group, F.explode(earlier).alias("full_date"))
        .distinct()
        .join(calendar.select("full_date", "date_key"), "full_date")
        .select(*group, "date_key")
    )
