"""Type 2 dimensions: dated snapshots overlaid on each other, and facts joined as of their date.

A snapshot is the whole dimension on one day and holds from that day until the day of the next
snapshot. The history keeps, per key, the intervals in which its attributes stayed the same. Taking a
snapshot in replaces what the history says about its interval and nothing else, so snapshots may come
in any order, a late one splits the versions around it, and one that comes again changes nothing.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelscope.functions.keys import surrogate_key
from parcelscope.operators.joins import hot_keys, spread_join
from parcelscope.sources.lake import Lake

LAYER = "gold"
START, END, HASH = "effective_start_date", "effective_end_date", "attribute_hash"
# The end of a version that still holds, inside this module; null outside.
OPEN = date(9999, 12, 31)


def attribute_hash(attributes: list[str]):
    """One value for all attributes; a null differs from any text."""
    return F.md5(F.to_json(F.struct(*attributes)))


def overlay(
    history: DataFrame, snapshot: DataFrame, as_of: date, until: date, key: str, attributes: list[str]
) -> DataFrame:
    """``history`` after a snapshot that holds from ``as_of`` to before ``until``.

    Only versions that reach or touch the interval are looked at again, which for the newest snapshot
    are the current ones; all others pass without a shuffle. The window sees one key's pieces, at
    most one per snapshot taken in.
    """
    columns = [key, *attributes, HASH, START, END]
    begin, end = F.lit(as_of), F.lit(until)
    near = (F.col(END) >= begin) & (F.col(START) <= end)
    touched = history.where(near)
    before = touched.where(F.col(START) < begin).withColumn(END, F.least(END, begin))
    after = touched.where(F.col(END) > end).withColumn(START, F.greatest(START, end))
    taken = (
        snapshot.where(F.col(key).isNotNull())
        .withColumn(HASH, attribute_hash(attributes))
        .groupBy(key)
        .agg(F.min(F.struct(HASH, *attributes)).alias("_taken"))
        .select(key, "_taken.*", begin.alias(START), end.alias(END))
        .select(columns)
    )
    pieces = before.select(columns).unionByName(after.select(columns)).unionByName(taken)
    per_key = W.partitionBy(key).orderBy(START)
    goes_on = (F.lag(END).over(per_key) == F.col(START)) & (F.lag(HASH).over(per_key) == F.col(HASH))
    version = F.sum(F.when(goes_on, 0).otherwise(1)).over(per_key)
    same = [F.min_by(c, START).alias(c) for c in [*attributes, HASH]]
    whole = (
        pieces.withColumn("_version", version)
        .groupBy(key, "_version")
        .agg(*same, F.min(START).alias("_start"), F.max(END).alias(END))
        .withColumnRenamed("_start", START)
    )
    return history.where(~near).select(columns).unionByName(whole.select(columns))


def apply_snapshot(
    lake: Lake, table: str, snapshot: DataFrame, as_of: date, key: str, attributes: list[str]
) -> DataFrame:
    """Take a snapshot into the stored history ``table``, and return the history.

    The days of the snapshots taken in are rows of the table with a null key, so they are replaced
    together with the versions, in one step, or not at all. Snapshot rows without a key are left out,
    and of rows that share a key the one with the least hash counts.
    """
    fields = snapshot.select(key, *attributes).schema
    if lake.exists(LAYER, table):
        stored = lake.table(LAYER, table).withColumn(END, F.coalesce(END, F.lit(OPEN)))
    else:
        empty = lake.spark.createDataFrame([], fields)
        stored = empty.withColumns(
            {HASH: F.lit(None).cast("string"), START: F.lit(as_of), END: F.lit(OPEN)}
        )
    days = stored.where(F.col(key).isNull())
    known = {row[START] for row in days.select(START).collect()}
    until = min((d for d in known if d > as_of), default=OPEN)
    versions = overlay(stored.where(F.col(key).isNotNull()), snapshot, as_of, until, key, attributes)
    if as_of not in known:
        marker = lake.spark.createDataFrame([(as_of,)], f"{START} date").withColumn(END, F.lit(OPEN))
        days = days.unionByName(marker, allowMissingColumns=True)
    rows = versions.unionByName(days.select(versions.columns))
    lake.refresh(rows.withColumn(END, F.nullif(F.col(END), F.lit(OPEN))), LAYER, table)
    return history(lake, table, key)


def history(lake: Lake, table: str, key: str) -> DataFrame:
    """The stored versions, with the key of the member, the key of the version, and whether it holds now."""
    versions = lake.table(LAYER, table).where(F.col(key).isNotNull())
    return versions.withColumns(
        {
            "member_key": surrogate_key(F.col(key)),
            "version_key": surrogate_key(F.col(key), F.col(START), sep="|"),
            "is_current": F.col(END).isNull(),
        }
    )


def as_of_join(
    facts: DataFrame, versions: DataFrame, key: str, day: str, columns: list[str], identity: list[str]
) -> DataFrame:
    """``facts`` with the ``columns`` of the version that held on their ``day``; null where none did.

    A key's versions travel as one list, of at most one element per snapshot, so every fact meets one
    row and none is multiplied; hot keys are spread by the facts' ``identity`` columns, and no task
    sorts a key's facts.
    """
    parts = dict.fromkeys([START, END, *columns])
    packed = versions.groupBy(key).agg(F.collect_list(F.struct(*parts)).alias("_versions"))
    joined = spread_join(facts, packed, hot_keys(facts, key, identity), key, identity, "left")
    holds = F.filter(
        "_versions", lambda v: (v[START] <= F.col(day)) & (v[END].isNull() | (F.col(day) < v[END]))
    )
    found = joined.withColumn("_held", F.get(holds, F.lit(0)))
    return found.select(*facts.columns, *[F.col(f"_held.{c}").alias(c) for c in columns])
