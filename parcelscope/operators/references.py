"""Reference checks of many relations at once."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Relation:
    """``child.column`` must be found in ``parent.key``."""

    child: DataFrame
    column: str
    parent: DataFrame
    key: str


def orphans(relations: list[Relation]) -> DataFrame:
    """One row with, per relation by its number k: ``keys_k`` and ``rows_k``, distinct child keys without a
    parent and the child rows that carry them, null left out, and ``nulls_k``, child rows with a null.

    Every table is read once, whatever the number of its relations, and gives rows of (relation, key,
    side). They meet in one aggregate over relation and key, which needs no join: a key without a
    parent is one that only children gave. Its map side sends a hot key, null among them, once per
    task. A second aggregate adds up the relations.
    """
    sides = []
    for table, ends in _ends(relations):
        given = [
            F.struct(F.lit(k).alias("k"), F.col(column).cast("string").alias("key"), F.lit(is_child).alias("child"))
            for k, column, is_child in ends
        ]
        sides.append(table.select(F.explode(F.array(*given)).alias("e")).select("e.*"))
    per_key = (
        reduce(DataFrame.unionAll, sides)
        .groupBy("k", "key")
        .agg(F.count_if("child").alias("n"), F.bool_or(~F.col("child")).alias("has_parent"))
    )

    def summed(what: Column, k: int, null: bool) -> Column:
        here = (F.col("k") == k) & (F.col("key").isNull() if null else F.col("key").isNotNull() & ~F.col("has_parent"))
        return F.coalesce(F.sum(F.when(here, what)), F.lit(0))

    totals = []
    for k in range(len(relations)):
        totals += [
            summed(F.lit(1), k, False).alias(f"keys_{k}"),
            summed(F.col("n"), k, False).alias(f"rows_{k}"),
            summed(F.col("n"), k, True).alias(f"nulls_{k}"),
        ]
    return per_key.agg(*totals)


def _ends(relations: list[Relation]) -> list[tuple[DataFrame, list[tuple[int, str, bool]]]]:
    """Per table the columns in which relations end: number, column, and whether it is the child's."""
    tables: dict[int, tuple[DataFrame, list[tuple[int, str, bool]]]] = {}
    for k, r in enumerate(relations):
        for table, column, is_child in ((r.child, r.column, True), (r.parent, r.key, False)):
            tables.setdefault(id(table), (table, []))[1].append((k, column, is_child))
    return list(tables.values())
