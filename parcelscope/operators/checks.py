"""Check rows: many conditions from one aggregate, one output row each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check(table: str, kind: str, result: Column, passed: Column | bool) -> Column:
    """One check as a struct. An unknown outcome (null) counts as failed."""
    outcome = F.lit(passed) if isinstance(passed, bool) else F.coalesce(passed, F.lit(False))
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(kind).alias("check_type"),
        result.cast("string").alias("result"),
        outcome.alias("passed"),
    )


def to_rows(totals: DataFrame, checks: list[Column]) -> DataFrame:
    """Turn a one-row aggregate into one row per check."""
    return totals.select(F.inline(F.array(*checks)))


def stacked(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def text(*parts: str | Column) -> Column:
    """Concatenate literal text and columns; a null column reads 'none'."""
    return F.concat(
        *[
            F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("none"))
            for p in parts
        ]
    )


def percent(fraction: Column, digits: int) -> Column:
    """A fraction as a percentage with a fixed number of decimals."""
    return F.concat(F.format_string(f"%.{digits}f", fraction * 100), F.lit("%"))
