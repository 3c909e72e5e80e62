"""Connected components of a graph too large for the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelscope.settings import staged


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b) per node with a link: the smallest node b that a reaches; the smallest itself is left out.

    Alternating stars: every node's larger neighbours are pointed at its smallest neighbour, then
    its smaller ones are, until nothing changes, in about log(longest path) rounds. Each round is
    written to the shared folder, so a lost executor costs a round at most. Minima are taken by
    partial aggregation, and a hot centre's links are split by adaptive execution.
    """
    links = links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("a"), F.least(a, b).alias("b")
    ).distinct()
    links, before = staged(links, "stars"), None
    while True:
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return links.withColumnsRenamed({"a": a, "b": b})
        before = now
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = staged(large.distinct(), "stars")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        links = staged(small.unionByName(low.withColumnRenamed("low", "b")).distinct(), "stars")
