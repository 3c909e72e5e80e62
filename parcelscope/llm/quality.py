"""Quality rules with thresholds learnt per language and source from mergeable quantile sketches.

A sketch is a histogram whose buckets keep six significant bits of a whole-number measure, so a
quantile is off by at most one part in 32. Sketches are rows (language, source, measure, bucket,
count): they merge by adding counts, partial aggregation sends a few hundred rows per task however
hot a group is, and the sum does not depend on the order of tasks, so reruns agree.

A document is rejected by the base rules, or if a measure lies outside its group's fences. A fence
comes from the tail of the group: starting at the outer quartile, each of the tail's quantiles pushes
the fence to twice its own distance from the median plus a small floor, as long as it lies within the
fence that the quantiles before it give. A tail that thins out is followed to its end; a separate lot
of odd documents, which makes the next quantile jump, is left outside, whether it is one in a hundred
of the group's documents or one in ten.

Small groups lean on their language and small languages on the corpus: to a group's counts come as
many as ``PRIOR`` documents spread like its language's, and to those of the language as many spread
like the corpus's. There is no size at which a group changes its rule.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelscope.llm.text import own_name, words
from parcelscope.settings import staged

LEAST_WORDS = 20
MOST_REPEATED = 30  # percent of words
WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
# The weight of what a group's sketch leans on, in documents.
PRIOR = 100
REACH = 2  # times the distance of a tail's quantile from the median
TAIL = (75, 90, 95, 98, 99)  # percent
PRECISION = 6  # significant bits of a bucket

# Measure: (expression over the base columns, floor, lower fence too). The measures are parts in a
# thousand of words or lines, and hundredths of a character.
MEASURES = {
    "symbols": ("n_symbols * 1000 DIV nullif(n_words, 0)", 30, False),
    "dup_lines": ("n_dup_lines * 1000 DIV nullif(n_lines, 0)", 150, False),
    "repeats": ("n_repeat_words * 1000 DIV nullif(n_words, 0)", 120, False),
    "word_length": ("word_chars * 100 DIV nullif(n_words, 0)", 60, True),
}
BASE = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it. The optimizer
    inlines a column that is named once, and would compute it anew for each element of a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def windows(hashes: Column) -> Column:
    """One hash per run of ``WINDOW`` (eight) consecutive word hashes: of neighbours, then of pairs
    of pairs, then of fours."""

    def pairs(h: Column, apart: int) -> Column:
        size = F.greatest(F.size(h) - apart, F.lit(0))
        ahead = F.slice(h, F.lit(1 + apart), size)
        return F.zip_with(F.slice(h, F.lit(1), size), ahead, lambda a, b: F.xxhash64(a, b))

    return let(let(pairs(hashes, 1), lambda h: pairs(h, 2)), lambda h: pairs(h, 4))


def covered(found: Column) -> Column:
    """How many words the windows that occur twice or more cover together."""

    def repeated(ordered: Column) -> Column:
        same = lambda e, i: (F.get(ordered, i - 1)["h"] == e["h"]) | (F.get(ordered, i + 1)["h"] == e["h"])
        return F.array_sort(F.transform(F.filter(ordered, same), lambda e: e["at"]))

    # a window covers its words, or those up to the next repeated window
    reach = lambda starts: F.transform(
        starts, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - p, F.lit(WINDOW)))
    )
    ordered = F.array_sort(F.transform(found, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
    total = F.aggregate(let(let(ordered, repeated), reach), F.lit(0), lambda a, b: a + b)
    return F.when(F.size(F.array_distinct(found)) < F.size(found), total).otherwise(0)


def base_columns(text: Column) -> dict[str, Column]:
    """Count columns in the order they must be added; names from ``_`` on are steps in between."""
    w, whole, lines = F.col("_words"), F.col("_text"), F.col("_lines")
    return {
        "_text": F.coalesce(text, F.lit("")),
        "_words": words(text),
        "n_words": F.size(w).cast("long"),
        "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_symbols": F.when(whole.rlike(SYMBOLS), F.regexp_count(whole, F.lit(SYMBOLS))).otherwise(0).cast("long"),
        # lines with a word: those that white space alone does not fill
        "_lines": F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        # every word is hashed once, then eight word hashes together: a window is known by 64 bits
        "n_repeat_words": let(let(F.transform(w, lambda x: F.xxhash64(x)), windows), covered).cast("long"),
    }


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base counts of each whole text and ``base_failed``. A null text has none. An
    input column that is called like a count is replaced."""
    steps = base_columns(F.col("_given"))
    made = [c for c in steps if not c.startswith("_")] + ["base_failed"]
    kept = [c for c in docs.columns if c not in made]
    row, out = own_name(docs, "_row"), docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("_given"))
    if {*steps, "_given"} & {*kept}:  # working columns get their names, the input's are packed away
        out = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias(row), F.col(f"`{text}`").alias("_given"))
    names = [c for c in out.columns if c != "_given"]
    for name, column in steps.items():
        out = out.withColumn(name, column)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    out = out.withColumn("base_failed", failed)
    own = [F.col(f"`{row}`.`{c}`") for c in kept] if row in names else [F.col(f"`{c}`") for c in kept]
    return out.select(*own, *made)


def bucket(value: Column) -> Column:
    """``value`` (not negative) with all but its leading ``PRECISION`` bits cleared."""
    low_bits = F.greatest(F.length(F.bin(value)) - PRECISION, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, low_bits), low_bits)


def sketches(rows: DataFrame, language: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, measure, bucket, n): the sketches of the documents that pass the base rules."""
    values = [
        F.struct(F.lit(name).alias("measure"), bucket(F.expr(value).cast("long")).alias("bucket"))
        for name, (value, _, _) in MEASURES.items()
    ]
    tall = rows.where("NOT base_failed").select(
        F.col(f"`{language}`").alias("lang"), F.col(f"`{source}`").alias("source"), F.explode(F.array(*values)).alias("v")
    )
    return tall.groupBy("lang", "source", "v.measure", "v.bucket").agg(F.count("*").alias("n"))


def blended(sketch: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, weight) of each group over all buckets of the corpus.

    The weight of a bucket is ``n + PRIOR * (share in the language, blended likewise with the corpus)``,
    multiplied out to whole numbers so that sums do not depend on their order. All levels are sums of
    the one sketch. Per group and measure there are as many rows as the corpus has buckets, a few
    hundred however many documents there are.
    """

    def level(keys: list[str], name: str) -> DataFrame:
        merged = sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").cast("decimal(38,0)").alias(name))
        return merged.withColumn(f"{name}_all", F.sum(name).over(Window.partitionBy(*keys, "measure")))

    def joined(left: DataFrame, right: DataFrame, keys: list[str], names: list[str], how: str) -> DataFrame:
        right = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *names)
        found = left.join(right, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]), how)
        return found.select(*left.columns, *names)

    corpus, language, own = level([], "c"), level(["lang"], "l"), level(["lang", "source"], "g")
    languages = language.select("lang", "measure", "l_all").distinct()
    grid = joined(languages, corpus, ["measure"], ["bucket", "c", "c_all"], "inner")
    grid = joined(grid, language, ["lang", "measure", "bucket"], ["l"], "left")
    groups = own.select("lang", "source", "measure").distinct()
    grid = joined(groups, grid, ["lang", "measure"], ["bucket", "c", "c_all", "l", "l_all"], "inner")
    grid = joined(grid, own, ["lang", "source", "measure", "bucket"], ["g"], "left")
    none, prior = F.lit(0).cast("decimal(38,0)"), F.lit(PRIOR).cast("decimal(38,0)")
    of = lambda name: F.coalesce(F.col(name), none)
    lean = of("l") * of("c_all") + prior * of("c")
    weight = of("g") * (of("l_all") + prior) * of("c_all") + prior * lean
    return grid.select("lang", "source", "measure", "bucket", weight.cast("decimal(38,0)").alias("weight"))


def fences(sketch: DataFrame) -> DataFrame:
    """(lang, source, <measure>_low, <measure>_high) of each group, from the tails of its blended sketch."""
    group = ["lang", "source"]
    of_measure = Window.partitionBy(*group, "measure")
    ranked = blended(sketch).withColumns(
        {"upto": F.sum("weight").over(of_measure.orderBy("bucket")), "total": F.sum("weight").over(of_measure)}
    )

    def at(percent: int) -> Column:
        return F.min(F.when(F.col("upto") * 100 >= F.col("total") * percent, F.col("bucket")))

    found = ranked.groupBy(*group, "measure").agg(
        at(50).alias("mid"),
        F.array(*[at(p) for p in TAIL]).alias("upper"), F.array(*[at(100 - p) for p in TAIL]).alias("lower"),
    )
    floors = F.create_map(*[F.lit(x) for name, (_, floor, _) in MEASURES.items() for x in (name, floor)])
    floor = floors[F.col("measure")].cast("long")

    def reach(away: Column) -> Column:
        """How far a fence stands from the median, from the distances of the tail's quantiles."""
        pushed = lambda d: d * REACH + floor
        return F.aggregate(
            F.slice(away, 2, len(TAIL)), pushed(F.get(away, F.lit(0))), lambda r, d: F.when(d <= r, pushed(d)).otherwise(r)
        )

    high = F.col("mid") + reach(F.transform("upper", lambda q: q - F.col("mid")))
    low = F.col("mid") - reach(F.transform("lower", lambda q: F.col("mid") - q))
    found = found.select(*group, "measure", high.alias("high"), low.alias("low"))
    of = lambda name, c: F.max(F.when(F.col("measure") == name, F.col(c)))
    return found.groupBy(*group).agg(
        *[of(name, "high").alias(f"{name}_high") for name in MEASURES],
        *[of(name, "low").alias(f"{name}_low") for name, (_, _, below) in MEASURES.items() if below],
    )


def judged(rows: DataFrame, limits: DataFrame, language: str = "lang", source: str = "source") -> DataFrame:
    """``rows`` of ``measured`` with ``kept``. ``limits`` has a few numbers per group and is joined
    on language and source, nulls being a group of their own; its size decides how."""
    inside = ~F.col("base_failed")
    for name, (value, _, low) in MEASURES.items():
        v = bucket(F.expr(value).cast("long"))  # as the sketches have it
        inside &= v <= limits[f"{name}_high"]
        if low:
            inside &= v >= limits[f"{name}_low"]
    at = rows[f"`{language}`"].eqNullSafe(limits["lang"]) & rows[f"`{source}`"].eqNullSafe(limits["source"])
    return rows.join(limits, at, "left").select(rows["*"], F.coalesce(inside, F.lit(False)).alias("kept"))


def with_quality(docs: DataFrame, text: str = "text", language: str = "lang", source: str = "source", carry: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: the ``carry`` columns (all by default), the base counts,
    ``base_failed`` and ``kept``.

    A null or empty text has no words and fails. Null languages and sources are groups like any
    other. Repeated rows count as often as they occur. The counts are written to the shared folder
    once, as both the sketches and the verdicts need them. An input column that has the name of a
    result column is left out.
    """
    made = [*BASE, "base_failed", "kept"]
    carry = [c for c in (docs.columns if carry is None else carry) if c not in made]
    needed = [c for c in dict.fromkeys([*carry, text, language, source])]
    rows = measured(docs.select(*[F.col(f"`{c}`") for c in needed]), text)
    rows = rows.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*carry, language, source])], *BASE, "base_failed")
    rows = staged(rows, "quality-counts")
    limits = staged(fences(staged(sketches(rows, language, source), "quality-sketch")), "quality-fences")
    return judged(rows, limits, language, source).select(*[F.col(f"`{c}`") for c in carry], *made)


def of_good_quality(docs: DataFrame, text: str = "text", language: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns.

    Texts are measured twice, once for the sketches and once for the verdicts, rather than written
    in between: measuring costs less than another copy of all texts.
    """
    groups = [F.col(f"`{c}`") for c in dict.fromkeys([text, language, source])]
    narrow = measured(docs.select(*groups), text)
    limits = staged(fences(staged(sketches(narrow, language, source), "quality-sketch")), "quality-fences")
    row = own_name(docs, "_whole")
    clash = [c for c in docs.columns if c in [*BASE, "base_failed", "kept"]]
    whole = docs.select("*", F.struct("*").alias(row)) if clash else docs
    verdicts = judged(measured(whole.drop(*clash), text), limits, language, source).where("kept")
    return verdicts.select(f"`{row}`.*") if clash else verdicts.select(*[F.col(f"`{c}`") for c in docs.columns])
