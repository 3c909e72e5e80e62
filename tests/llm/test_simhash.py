"""SimHash near-duplicates against a brute-force version."""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from parcelscope.llm import simhash
from parcelscope.llm.components import components
from parcelscope.llm.shipping import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain_fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = [w for w in re.split("[ \t\n\x0b\x0c\r]+", lower) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest id per row, by comparing all pairs of (id, fingerprint)."""
    low = list(range(len(prints)))

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for i, j in combinations(range(len(prints)), 2):
        if (prints[i][1] ^ prints[j][1]).bit_count() <= 3:
            a, b = root(i), root(j)
            low[max(a, b)] = min(a, b)
    members = {}
    for i, (doc, _) in enumerate(prints):
        members.setdefault(root(i), []).append(doc)
    return [min((d for d in members[root(i)] if d is not None), default=None) for i in range(len(prints))]


@pytest.mark.parametrize(
    "text", [None, "", " \n\t", "One", "one two", "A b c d", "x " * 500, "ÄÖ ß É x y", "a\x0bb\x0cc\rd"]
)
def test_fingerprint(text):
    assert simhash.fingerprint_of(text) == plain_fingerprint(text)


def test_fingerprint_over_pieces(monkeypatch):
    text = " ".join(f"w{i * i % 91}" for i in range(1000))
    whole = simhash.fingerprint_of(text)
    monkeypatch.setattr(simhash, "PIECE", 7)
    assert simhash.fingerprint_of(text) == whole == plain_fingerprint(text)


def test_blocks_leave_every_three_positions_out():
    blocks = simhash.steiner_blocks()
    assert len(blocks) == 14
    for three in combinations(range(8), 3):
        differing = sum(1 << p for p in three)
        assert any(b & differing == 0 for b in blocks)


def test_splits_keep_every_pair_within_three_bits():
    rng = np.random.default_rng(3)
    blocks = [simhash._byte_mask(b) for b in simhash.steiner_blocks()]
    for _ in range(300):
        apart = sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
        lists = [i for i, m in enumerate(blocks) if m & apart == 0]
        for masks in simhash.finer_masks():
            per = len(masks[0])
            lists = [i * per + n for i in lists for n, m in enumerate(masks[i]) if m & apart == 0]
            assert lists


def cluster(n, base=0x0123456789ABCDEF, seed=1):
    """Fingerprints around one value: long posting lists with many links and some gaps."""
    rng = np.random.default_rng(seed)
    found = {base}
    while len(found) < n:
        found.add(base ^ sum(1 << int(b) for b in rng.choice(40, rng.integers(1, 7), replace=False)))
    return sorted(found)


@pytest.mark.parametrize("most", [2, 16, 10_000])
def test_classes_of_a_dense_cluster(spark, most):
    ship(spark)
    prints = [(i * 7 % 401, p) for i, p in enumerate(cluster(150) + [5, 5, 4, 1 << 63, (1 << 63) | 7])]
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in prints]
    found = simhash.classes(spark.createDataFrame(signed, "doc_id long, fp long"), list_most=most)
    got = {r["fp"]: r["component_id"] for r in found.collect()}
    assert [got[s] for _, s in signed] == plain_components(prints)


DOCS = [
    (5, "The cat sat on the mat today", "en", "a", 1),
    (3, "the CAT sat\non the mat  today", "en", "b", 1),
    (3, "the CAT sat\non the mat  today", "en", "b", 1),  # a repeated row
    (9, "something else entirely here", None, None, None),
    (8, None, None, None, None),
    (7, "", "en", "a", 0),
    (None, "only nameless documents say this", "en", "a", 1),
    (None, "only nameless documents say this", "en", "a", 1),
    (None, "something else entirely here", "en", "a", 1),
]


def test_near_duplicates(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA).selectExpr("*", "1 AS fp", "2 AS component_id")
    rows = simhash.near_duplicates(docs).collect()
    prints = [(d[0], plain_fingerprint(d[1])) for d in DOCS]
    want = [(i, f"{p:016x}", c) for (i, p), c in zip(prints, plain_components(prints))]
    assert sorted(map(str, [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows])) == sorted(map(str, want))


def test_one_document_of_each_class_stays(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA).selectExpr("*", "1 AS root")
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(kept.select("doc_id").collect(), key=str) == sorted([(3,), (7,), (9,), (None,)], key=str)


def test_rows_that_share_an_id_are_told_apart_by_text(spark):
    rows = [(1, "a b c d e", "en", "s", 1), (2, "a b c d e", "en", "s", 1), (2, "f g h i j k", "en", "s", 1), (2, "f g h i j k", "en", "s", 1)]
    kept = simhash.without_near_duplicates(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "0 AS _fp", "0 AS doc"))
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(1, "a b c d e"), (2, "f g h i j k")]


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.without_near_duplicates(docs).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    links = [(i + 1, i) for i in range(40)] + [(200 + i, 100) for i in range(1, 20)] + [(5, 5)]
    found = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert {(r["a"], r["b"]) for r in found} == {(i, 0) for i in range(1, 41)} | {(200 + i, 100) for i in range(1, 20)}
