"""Positions in a global order, without gathering rows of a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelscope.llm.text import own_name
from parcelscope.settings import staged


def numbered(rows: DataFrame, group: list[str], order: list[str], pos: str = "pos", total: str = "n") -> DataFrame:
    """``rows`` with their position (from 0) in the ``order`` of their ``group``, and the group's size.

    Rows are dealt by ranges of group and order and written sorted; a position is the row's place in
    its range plus the sizes of the group's earlier ranges. The windows run over one row per group
    and range. ``order`` should tell all rows apart; rows it does not tell apart are numbered in any
    order and may share a task. Nulls come first and form one group.
    """
    at, part, first, before = (own_name(rows, name) for name in ("at", "part", "first", "before"))
    keys = [F.col(f"`{c}`") for c in [*group, *order]]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # the upper bits number the range, the lower 33 the row in it
    ordered = staged(ordered.withColumn(at, F.monotonically_increasing_id()), "ordered")
    ordered = ordered.withColumn(part, F.shiftright(at, 33))
    ranges = ordered.groupBy(*group, part).agg(F.min(at).alias(first), F.count(F.lit(1)).alias(total))
    whole = Window.partitionBy(*(group or [F.lit(0)]))
    earlier = whole.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn(before, F.coalesce(F.sum(total).over(earlier), F.lit(0))).withColumn(
        total, F.sum(total).over(whole)
    )
    ranges = staged(ranges, "ranges")
    same = [ordered[c].eqNullSafe(ranges[c]) for c in [*group, part]]
    placed = ordered.join(ranges, same)
    return placed.select(
        *[ordered[c] for c in rows.columns],
        (ordered[at] - ranges[first] + ranges[before]).alias(pos),
        ranges[total].alias(total),
    )
