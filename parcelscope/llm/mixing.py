"""Mixing sources to target weights, in DataFrame operations only.

Every document has a hash-random key. A source's documents in key order, repeated as often as
needed, are its stream; the mix takes the stream's first words up to the source's target. As keys
are hexadecimal and uniform, a key's leading digits are ranges of equal share: prefix sums of word
counts are taken over ranges, the range in which a source's budget ends is cut into finer ranges,
and only the few documents of the last one are summed one by one. What results is one cut per
source (whole epochs, the key the rest ends at, words left for it), and each document is decided by
comparing its key with the cut: no document is shuffled or ranked, and a hot source is no different
from others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelscope.llm.text import own_name, words
from parcelscope.settings import staged

WEIGHTS = (5, 2, 1)
PERCENT = 150
MOST_EPOCHS = 2
SEED = "mix-1"
# Hexadecimal digits per round of cutting: 4,096 ranges, and 4,096 of the one that matters.
DIGITS = 3
ROUNDS = 2


def document_key(id: Column, text: Column) -> Column:
    """32 hexadecimal digits; rows that agree in id and text share a key."""
    return F.md5(F.concat_ws("|", F.lit(SEED), F.coalesce(id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))))


def sized(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, key) per document."""
    return docs.select(
        F.col(f"`{id}`").alias("doc_id"),
        F.col(f"`{source}`").alias("source"),
        F.size(words(F.col(f"`{text}`"))).cast("long").alias("size"),
        document_key(F.col(f"`{id}`"), F.col(f"`{text}`")).alias("key"),
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = PERCENT, most: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size, target) of each source.

    Sources by code point, null last, weigh ``weights`` in turn. A target is the source's weight
    times a common level, or ``most`` times its size if that is less; the level is what makes the
    targets add up to ``percent`` of all words. Sharing a capped source's excess by weight again
    and again ends at the same level. The windows run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    per = per.withColumn("weight", weight).withColumn("most", F.col("source_size") * most)
    # sources in the order in which a rising level caps them
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    budget = F.sum("source_size").over(everything) * percent / F.lit(100)
    left = budget - F.coalesce(F.sum("most").over(before), F.lit(0))
    per = per.withColumn("level", left / F.sum("weight").over(after))
    # the first level that does not cap its own source holds for it and all after it
    fits = F.col("level") * F.col("weight") <= F.col("most")
    per = per.withColumn("fits", fits)
    first = F.first(F.when(F.col("fits"), F.col("level")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    per = per.withColumn("common", first)
    target = F.least(F.col("common") * F.col("weight"), F.col("most").cast("double"))
    return per.select("source", "source_size", F.coalesce(target, F.col("most").cast("double")).alias("target"))


def cuts(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """(source, source_size, target, epochs, at, words, tied): each source's stream is taken
    ``epochs`` times whole, once more for keys below ``at``, and for ``words`` more words from
    the documents with key ``at``, of which there are ``tied``; keys repeat only with ids."""
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    state = goals.withColumn("epochs", epochs).withColumn(
        "words", F.floor(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")
    ).withColumn("at", F.lit(""))
    for last in [*[False] * ROUNDS, True]:
        state = staged(state, "mixing-cut")
        upto = F.col("key") if last else F.substring("key", F.lit(1), F.length("at") + DIGITS)
        inside = sizes.join(state.select(F.col("source").alias("_source"), "at", "words"), sizes["source"].eqNullSafe(F.col("_source")))
        inside = inside.where(F.col("key").startswith(F.col("at")) & (F.col("words") > 0))
        ranges = inside.groupBy("source", "words", upto.alias("upto")).agg(F.sum("size").alias("sum"), F.count("*").alias("n"))
        running = Window.partitionBy("source").orderBy("upto")
        ranges = ranges.withColumn("end", F.sum("sum").over(running))
        hit = ranges.where((F.col("end") >= F.col("words")) & (F.col("end") - F.col("sum") < F.col("words")))
        found = hit.select(
            F.col("source").alias("_source"), F.col("upto").alias("_at"), (F.col("words") - F.col("end") + F.col("sum")).alias("_words"), F.col("n").alias("_tied")
        )
        state = (
            state.drop("tied").join(found, state["source"].eqNullSafe(found["_source"]), "left")
            .select("source", "source_size", "target", "epochs", F.coalesce("_at", "at").alias("at"), F.coalesce("_words", "words").alias("words"), F.coalesce("_tied", F.lit(1)).alias("tied"))
        )
    return staged(state, "mixing-cut")


def last_taken(key: Column, size: Column, of=F.col) -> Column:
    """Words taken of a document after the whole epochs; ``of`` names a column of its source's cut.
    Documents that tie on the last key share its words evenly."""
    part = F.least(F.floor(of("words") / of("tied")).cast("long"), size)
    return F.when(of("words") == 0, 0).when(key < of("at"), size).when(key == of("at"), part).otherwise(0)


def mixed(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) per row of ``docs``.

    A null text has size 0; a null source is a source, the last; an empty table gives no rows.
    Documents do not move: the per-source cuts are joined to them, by a broadcast if they are few.
    """
    rows = staged(sized(docs, id, text, source), "mixing-sizes")
    cut = cuts(rows, targets(rows)).withColumnRenamed("source", "_source")
    joined = rows.join(cut, rows["source"].eqNullSafe(cut["_source"]))
    return joined.select("doc_id", "source", "size", "source_size", "target", (F.col("epochs") * F.col("size") + last_taken(F.col("key"), F.col("size"))).alias("taken"))


def mixture(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", length: str = "n_chars") -> DataFrame:
    """The mix itself: rows of ``docs`` as often as they are taken, the one document per source at
    which the budget ends with its last copy cut after the words that are left.

    ``length``, if it is a column, is counted anew for a cut copy. Documents without words are left
    out. Other columns are kept as they are.
    """
    rows = staged(sized(docs, id, text, source), "mixing-sizes")
    key, size, cut, copy = (own_name(docs, c) for c in ("_key", "_size", "_cut", "_copy"))
    per = cuts(rows, targets(rows)).select(F.struct("*").alias(cut))
    body, of = F.col(f"`{text}`"), lambda c: F.col(f"{cut}.{c}")
    all_docs = docs.select("*", F.size(words(body)).cast("long").alias(size), document_key(F.col(f"`{id}`"), body).alias(key))
    joined = all_docs.join(per, F.col(f"`{source}`").eqNullSafe(of("source")))
    last = last_taken(F.col(key), F.col(size), of)
    repeated = joined.withColumn(size, F.when(F.col(size) > 0, last)).where(F.col(size).isNotNull() & (copies_of(of, F.col(size)) > 0))
    repeated = repeated.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), copies_of(of, F.col(size)))))
    pieces = F.split(body, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    short = (F.col(copy) > of("epochs")) & (F.col(size) < F.size(words(body)))
    cut_text = F.array_join(F.slice(pieces, F.lit(1), F.col(size).cast("int")), "")
    columns = []
    for c in docs.columns:
        own = F.col(f"`{c}`")
        if c == text:
            own = F.when(short, cut_text).otherwise(body)
        elif c == length:
            own = F.when(short, F.length(cut_text)).otherwise(own).cast(docs.schema[c].dataType)
        columns.append(own.alias(c))
    return repeated.select(*columns)


def copies_of(of, last: Column) -> Column:
    return of("epochs") + F.when(last > 0, 1).otherwise(0)
