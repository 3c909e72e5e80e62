"""Mixing against its SQL and a step-by-step sharing of the excess."""

from __future__ import annotations

from collections import Counter

import pytest

from parcelscope.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain_targets(sizes):
    """Share by weight, cap, share the excess again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_, left = dict.fromkeys(names, 0.0), set(names), 1.5 * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        for s in over or open_:
            target[s] = 2 * sizes[s] if over else level * weight[s]
        if not over:
            break
        left -= sum(2 * sizes[s] for s in over)
        open_ -= over
    return target


def made(sources):
    rows, i = [], 0
    for source, sizes in sources.items():
        for n in sizes:
            rows.append((i, None if n is None else "  ".join(["w"] * n) + "\n", "en", source, 3))
            i += 1
    return rows


CASES = [
    {"a": [10] * 30, "b": [7, 3] * 20, "c": [1] * 50, None: [5] * 10},
    {"z": [1], "é": [3, None, 0], "A": [1000]},
    {"only": [4, 4, 4]},
    {"none": [0, None], "some": [9] * 9},
    {"zero": [0]},
]


@pytest.mark.parametrize("case", CASES)
def test_targets_and_taken(spark, case):
    docs = spark.createDataFrame(made(case), SCHEMA).selectExpr("*", "1 AS size", "2 AS key", "3 AS target")
    rows = mixing.mixed(docs).collect()
    sizes = {s: sum(n or 0 for n in ns) for s, ns in case.items()}
    want = plain_targets(sizes)
    assert len(rows) == sum(map(len, case.values()))
    for s in case:
        own = [r for r in rows if r["source"] == s]
        assert all(r["target"] == pytest.approx(want[s]) and r["source_size"] == sizes[s] for r in own)
        assert sum(r["taken"] for r in own) == int(want[s] + 1e-9)
        epochs = int(want[s] // sizes[s]) if sizes[s] else 0
        assert all(epochs * r["size"] <= r["taken"] <= min(epochs + 1, 2) * r["size"] for r in own)
    again = mixing.mixed(docs.repartition(3)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_mixture_has_the_words_taken(spark):
    docs = spark.createDataFrame(made(CASES[0]), SCHEMA).selectExpr("*", "1 AS _size", "2 AS words")
    taken = {r["doc_id"]: r["taken"] for r in mixing.mixed(docs).collect()}
    mix = mixing.mixture(docs)
    assert mix.columns == docs.columns
    texts = {r[0]: r[1] for r in docs.select("doc_id", "text").collect()}
    got = Counter()
    for r in mix.collect():
        got[r["doc_id"]] += len(r["text"].split())
        assert texts[r["doc_id"]].startswith(r["text"])
        if r["text"] != texts[r["doc_id"]]:
            assert r["n_chars"] == len(r["text"])
    assert got == Counter({d: n for d, n in taken.items() if n})


def test_repeated_rows_share_a_key(spark):
    rows = [(1, "a b c d", "en", "s", 7)] * 6 + [(None, "x y", None, None, None)] * 3
    out = mixing.mixed(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == 9 and all(r["taken"] <= 2 * r["size"] for r in out)


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mixing.mixed(docs).count() == 0 and mixing.mixture(docs).count() == 0
