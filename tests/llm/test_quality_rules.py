"""Quality counts against plain Python, and the fences on made-up groups."""

from __future__ import annotations

import re
from collections import Counter

from parcelscope.llm import quality
from parcelscope.llm.text import table

SCHEMA = "doc_id long, text string, lang string, source string"


def plain(text):
    words = [w for w in re.split("[ \t\n\x0b\x0c\r]+", text or "") if w]
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {p for i, w in enumerate(windows) if often[w] > 1 for p in range(i, i + 8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def counts(df):
    return {
        r["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        for r in df.collect()
    }


def test_counts(spark):
    run = " ".join(f"w{i}" for i in range(9))
    texts = [
        None, "", " \n ", "one", "a # b *$%&|<> c", "x\nx\n\n\n x\ny\nx", "ü ß 🎉 é", f"{run} gap {run} end",
        "a b " * 30, "same " * 8, "same " * 9, f"{run}\n{run}", "w " * 20_000, "\x0b\x0c\r", " ".join(f"v{i}" for i in range(40)),
    ]
    rows = [(i, t, None, "s") for i, t in enumerate(texts)]
    got = counts(quality.measured(spark.createDataFrame(rows, SCHEMA)))
    for i, text in enumerate(texts):
        n, *rest = plain(text)
        assert got[i] == (n, *rest, n < 20 or 100 * rest[-1] > 30 * n), repr(text)[:60]


def test_counts_of_the_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = counts(quality.measured(docs))
    assert {i: v[:5] for i, v in got.items()} == {r["doc_id"]: plain(r["text"]) for r in docs.collect()}


def document(i, junk=False):
    words = [f"word{i * 31 % 97 + k}" for k in range(40)]
    return " ".join(w + "%%%" for w in words) if junk else " ".join(words)


def test_fences_follow_the_group(spark):
    # symbols are usual in source "code" and odd in "prose"; a small source follows its language
    rows = [(i, document(i), "en", "prose") for i in range(120)]
    rows += [(200 + i, document(i, junk=True), "en", "code") for i in range(120)]
    rows += [(400, document(1, junk=True), "en", "prose"), (401, document(2), "de", None), (402, document(3), None, "tiny")]
    rows += [(500, None, "en", "prose"), (501, "", None, None), (502, " \n", "en", "prose")]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "7 AS n_words", "8 AS _words", "9 AS _row")
    kept = {r["doc_id"]: r["kept"] for r in quality.with_quality(docs, carry=["doc_id"]).collect()}
    assert len(kept) == len(rows)
    gone = {400, 500, 501, 502}
    assert kept == {r[0]: r[0] not in gone for r in rows}
    filtered = quality.of_good_quality(docs)
    assert filtered.columns == docs.columns
    assert {tuple(r) for r in filtered.collect()} == {(*r, 7, 8, 9) for r in rows if r[0] not in gone}


def sketch(spark, *groups):
    """A sketch of made-up groups: (lang, source, {value: documents}) of one measure."""
    rows = [(lang, source, "dup_lines", v, n) for lang, source, values in groups for v, n in values.items()]
    return spark.createDataFrame(rows, "lang string, source string, measure string, bucket long, n long")


def fence(spark, *groups):
    found = quality.fences(sketch(spark, *groups)).collect()
    return {(r["lang"], r["source"]): r["dup_lines_high"] for r in found}


def plain_fence(groups, lang, source, floor=150):
    """The same by exact fractions."""
    from fractions import Fraction

    def shares(picked):
        total = sum(sum(v.values()) for _, _, v in picked)
        out = Counter()
        for _, _, values in picked:
            for v, n in values.items():
                out[v] += Fraction(n, total)
        return out, total

    prior = quality.PRIOR
    corpus, _ = shares(groups)
    language, n = shares([g for g in groups if g[0] == lang])
    own = next(g[2] for g in groups if g[:2] == (lang, source))
    weight = {v: own.get(v, 0) + Fraction(prior, n + prior) * (n * language[v] + prior * corpus[v]) for v in corpus}
    total = sum(weight.values())

    def at(percent):
        seen = 0
        for v in sorted(weight):
            seen += weight[v]
            if seen * 100 >= total * percent:
                return v

    mid, reach = at(50), None
    for percent in quality.TAIL:
        away = at(percent) - mid
        if reach is None or away <= reach:
            reach = quality.REACH * away + floor
    return mid + reach


def test_fences_follow_thinning_tails_and_leave_lots_outside(spark):
    groups = [
        ("en", "plain", {0: 100_000}), ("en", "tail", {0: 90_000, 40: 6000, 120: 3000, 240: 900, 400: 100}),
        ("en", "lot", {0: 90_000, 960: 10_000}), ("en", "tiny", {0: 2, 240: 1}), ("de", None, {240: 1}), (None, None, {0: 7, 40: 5}),
        ("fr", "x", {120: 10**10, 240: 10**9}),
    ]
    got = fence(spark, *groups)
    assert got == {(lang, source): plain_fence(groups, lang, source) for lang, source, _ in groups}
    assert got["en", "plain"] == 150 and got["en", "lot"] == 150  # a tenth of odd documents moves nothing
    assert got["en", "tail"] > 400
    assert quality.fences(sketch(spark, *groups).limit(0)).count() == 0


def test_small_groups_lean_on_their_language_by_count(spark):
    """A group's fence moves from its language's to its own without a step at any size."""
    fences = []
    for n in (1, 3, 20, 90, 99, 101, 150, 10_000):
        groups = [("en", "big", {0: 10**6}), ("en", "own", {120: n})]
        fences.append(fence(spark, *groups)["en", "own"])
        assert fences[-1] == plain_fence(groups, "en", "own")
    assert fences[0] == 150 and fences[1:4] == [390] * 3 and fences[-2:] == [270] * 2


def test_fences_of_the_documents_differ_and_decide(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    rows = quality.measured(docs).cache()
    limits = quality.fences(quality.sketches(rows))
    found = limits.collect()
    assert len(found) == 80
    for name in ("dup_lines_high", "repeats_high", "word_length_high", "word_length_low"):
        assert len({r[name] for r in found}) > 4, name
    judged = quality.judged(rows.select("doc_id", "lang", "source", *quality.BASE, "base_failed"), limits)
    labels = table(spark, "/root/testdata/sf0.1", "labels")
    seen = judged.where("NOT base_failed").join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    n = {(r["quality"], r["kept"]): r["count"] for r in seen}
    assert n.get((1, False), 0) <= 0.005 * n[1, True]  # clean documents stay
    assert n[0, False] >= 0.95 * (n[0, False] + n.get((0, True), 0))  # poor ones go
    # no floor alone explains it: a document goes for its repeats or lines, with fences above the floors
    tails = [r for r in found if r["repeats_high"] > 130 or r["dup_lines_high"] > 160]
    assert len(tails) > 40
    rows.unpersist()


def test_bucket_error_is_one_part_in_32(spark):
    values = [*range(0, 3000, 7), 10**9, 2**40 + 12345]
    rows = spark.createDataFrame([(v,) for v in values], "v long").select("v", quality.bucket(quality.F.col("v")).alias("b"))
    for r in rows.collect():
        assert r["b"] <= r["v"] and (r["v"] - r["b"]) * 32 <= r["v"]


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert quality.with_quality(docs).count() == 0
    assert quality.of_good_quality(docs).count() == 0
