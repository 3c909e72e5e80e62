"""One row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: list[str], newest: list[Column], keep: list[str]
) -> DataFrame:
    """The ``keep`` columns of each key's newest row.

    The same answer as "row number 1 in descending order, nulls last", written as a maximum over a
    struct: every map task sends at most one row per key, so a hot key costs no more than any
    other, and the result is known to be unique on ``keys``, which lets the optimizer drop a left
    join to it when its columns are not used. The kept columns end the ordering, so ties cannot
    give different answers from run to run.
    """
    order = [c.alias(f"o{i}") for i, c in enumerate(newest)]
    kept = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    top = F.max(F.struct(*order, *kept)).alias("top")
    return (
        df.groupBy(*keys)
        .agg(top)
        .select(*keys, *[F.col(f"top.k{i}").alias(c) for i, c in enumerate(keep)])
    )
