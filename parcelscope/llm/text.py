"""What the text operators share: the word rule, whole-text reading and null handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: a word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text, in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def own_name(df: DataFrame, name: str) -> str:
    """``name``, or the first of ``name_1``, ``name_2``, ... that ``df`` has no column of.

    Working columns get their names here, so that extra columns of the input never clash.
    """
    taken = {c.lower() for c in df.columns}
    wanted, k = name, 0
    while wanted.lower() in taken:
        k += 1
        wanted = f"{name}_{k}"
    return wanted
