"""Joins beyond a plain equi-join: orphan searches and hot-key spreading."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 2_000_000
SAMPLE_ONE_IN = 1_000
# A hot-key list of up to this many rows (key and number, well under a megabyte) is sent to every
# task; a longer one is looked up by a spread join.
MOST_LISTED = 10_000
LOOKUPS = 1_024
# From this estimated size on, a table's keys are compared with a dimension before its rows are moved;
# a list of up to this many exceptions (key and number, a few megabytes) is sent to every task.
LOOK_BYTES = 32 * 1024 * 1024
MOST_ODD = 100_000
# Null keys of a left join match nothing and are dealt over this many salts.
NULL_SALTS = 1 << 20


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Distinct child keys with no parent, and how many child rows carry each.

    Keys are counted before the anti join, so a hot key travels as one row. A null key matches no
    parent and is therefore an orphan.
    """
    keys = child.groupBy(F.col(column).alias("orphan")).agg(F.count(F.lit(1)).alias("n_rows"))
    parents = parent.select(F.col(parent_column).alias("orphan"))
    return keys.join(parents, "orphan", "left_anti")


def hot_keys(
    df: DataFrame, key: str, identity: list[str], hot_rows: int = HOT_ROWS,
    one_in: int = SAMPLE_ONE_IN,
) -> DataFrame:
    """(key, _salts): keys that carry about ``hot_rows`` rows or more, found from a 1-in-``one_in``
    look, and the number of tasks that leaves each about ``hot_rows`` of them.

    Which rows are looked at depends only on their ``identity`` columns, so every evaluation finds
    the same keys, also after a lost executor. There is at most one hot key per ``hot_rows`` rows.
    The look decides how a key is joined, never what the join returns.
    """
    seen = F.pmod(F.xxhash64(*identity), F.lit(one_in)) == 0
    salts = F.ceil(F.col("_seen") * one_in / hot_rows).cast("int")
    return (
        df.where(F.col(key).isNotNull() & seen)
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_seen"))
        .where(F.col("_seen") >= max(1, hot_rows // one_in))
        .select(key, F.greatest(salts, F.lit(1)).alias("_salts"))
    )


def _salted(df: DataFrame, hot: DataFrame, key: str, identity: list[str] | None, listed: bool) -> DataFrame:
    """``df`` with the ``_salts`` of its key, null for other keys."""
    if listed:
        return df.join(F.broadcast(hot), key, "left")
    if identity is None:  # one row or few per key: nothing to spread
        return df.join(hot, key, "left")
    # the list is copied per lookup salt, so that not even the lookup gathers a hot key
    look = F.pmod(F.xxhash64(F.lit(2), *identity), F.lit(LOOKUPS)).cast("int")
    copies = hot.withColumn("_look", F.explode(F.sequence(F.lit(0), F.lit(LOOKUPS - 1))))
    return df.withColumn("_look", look).join(copies, [key, "_look"], "left").drop("_look")


def spread_join(
    many: DataFrame,
    one: DataFrame,
    hot: DataFrame,
    key: str,
    identity: list[str],
    how: str = "inner",
    most_listed: int = MOST_LISTED,
) -> DataFrame:
    """``many`` joined to ``one`` on ``key`` with the ``hot`` keys spread over their ``_salts`` tasks.

    Rows of a hot key get a salt from their own ``identity`` columns and meet one of as many copies
    of the matching ``one`` rows; all other keys join with salt 0. For joins whose right side is
    itself computed on the join key: adaptive execution splits a skewed partition only where both
    join inputs come straight from a shuffle. The list of ``hot_keys`` is measured first, at most
    ``most_listed + 1`` of its rows: none plans no look-up, a short list is broadcast, a longer one
    is looked up by a join that is spread itself. ``how`` is inner or left; rows of a left join
    with a null key, which match nothing, are dealt out evenly.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"spread_join cannot be {how}")
    found = hot.limit(most_listed + 1).collect()
    row = F.xxhash64(F.lit(1), *identity)
    null_salt = F.pmod(row, F.lit(NULL_SALTS)).cast("int")
    if not found:
        if how == "inner":
            return many.join(one, key)
        nulls_spread = many.withColumn("_salt", F.when(F.col(key).isNull(), null_salt).otherwise(0))
        # zero, but not as a literal, which the optimizer would take out of the join's keys
        zero = F.pmod(F.xxhash64(key), F.lit(1)).cast("int")
        return nulls_spread.join(one.withColumn("_salt", zero), [key, "_salt"], how).drop("_salt")
    listed = len(found) <= most_listed
    if listed:
        hot = many.sparkSession.createDataFrame(found, hot.schema)
    salt = F.when(F.col("_salts").isNotNull(), F.pmod(row, F.col("_salts")).cast("int"))
    salted = _salted(many, hot, key, identity, listed).withColumn(
        "_salt", F.coalesce(salt, F.when(F.col(key).isNull(), null_salt).otherwise(0))
    )
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    copied = _salted(one, hot, key, None, listed).withColumn("_salt", F.explode(copies))
    return salted.drop("_salts").join(copied.drop("_salts"), [key, "_salt"], how).drop("_salt")


def odd_keys(many: DataFrame, one: DataFrame, key: str) -> DataFrame:
    """(key, _n): keys of ``many`` that ``one`` does not have exactly once, and how often it has them.

    Only keys cross the network, a hot one as one row per task; a null key is none.
    """
    given = many.select(key, F.lit(1).alias("_asked"), F.lit(0).alias("_held"))
    held = one.select(key, F.lit(0).alias("_asked"), F.lit(1).alias("_held"))
    counts = given.unionByName(held).where(F.col(key).isNotNull()).groupBy(key)
    counts = counts.agg(F.max("_asked").alias("_asked"), F.sum("_held").alias("_n"))
    return counts.where((F.col("_asked") == 1) & (F.col("_n") != 1)).select(key, "_n")


def known_join(
    many: DataFrame,
    one: DataFrame,
    key: str,
    rows: DataFrame,
    look_bytes: int = LOOK_BYTES,
    most_listed: int = MOST_ODD,
) -> DataFrame:
    """``many`` joined to the ``key`` column of ``one``, inner; the wide rows stay where they are if they can.

    Nearly all rows of a table have their one match in a dimension, so the exceptions are looked for
    first, as ``odd_keys``. None needs no join at all, a short list is sent to every task, and a list
    of more than ``most_listed`` keys, or a table whose estimated size is under ``look_bytes``, for
    which the look would cost more than the shuffle, takes the plain join. ``rows`` is what ``many``
    was made from, cheaper to look in; it has all of its keys.
    """
    one = one.select(key)
    if _estimated_bytes(rows) < look_bytes:
        return many.join(one, key)
    odd = odd_keys(rows, one, key)
    found = odd.limit(most_listed + 1).collect()
    if len(found) > most_listed:
        return many.join(one, key)
    known = many.where(F.col(key).isNotNull())
    if not found:
        return known
    listed = F.broadcast(many.sparkSession.createDataFrame(found, odd.schema))
    once = known.join(listed, key, "left").where(F.coalesce("_n", F.lit(1)) > 0)
    if all(row["_n"] == 0 for row in found):
        return once.drop("_n")
    times = F.explode(F.sequence(F.lit(1), F.coalesce("_n", F.lit(1)))).alias("_time")
    return once.select("*", times).drop("_n", "_time")


def _estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size of ``df``, from which it also chooses broadcasts."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def totals_side_by_side(*frames: DataFrame) -> DataFrame:
    """Combine one-row totals with distinct column names into one row.

    Stacked and folded by an aggregate, so no cross join is planned and a frame with more than one
    row could not multiply the others.
    """
    tall = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return tall.agg(*[F.max(c).alias(c) for c in tall.columns])
