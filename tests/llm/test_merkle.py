"""Manifest and proofs against a plain tree in memory."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from parcelscope.llm import merkle
from parcelscope.llm.shipping import ship
from parcelscope.llm.suite import QUERIES

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row) -> str:
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row]
    return digest("".join(parts))


def plain_tree(nodes: list[str]) -> tuple[str, list[list[str]]]:
    """Root, and per node its siblings by level."""
    siblings: list[list[str]] = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for n, i in enumerate(at):
            run = i // 16 * 16
            siblings[n].append("".join(nodes[run:i]) + "".join(nodes[i + 1 : run + 16]))
        nodes = [digest("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
        at = [i // 16 for i in at]
    return nodes[0], siblings


def plain_manifest(rows):
    """Root, and sorted (doc_id, leaf, subroot, proof digest) of all rows."""
    groups: dict = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0], plain_leaf(row)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for group in order:
        groups[group].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees.append(plain_tree([leaf for _, leaf in groups[group]]))
    root, tops = plain_tree([subroot for subroot, _ in trees])
    out = []
    for group, (subroot, siblings), top in zip(order, trees, tops):
        for (doc_id, leaf), own in zip(groups[group], siblings):
            out.append((doc_id, leaf, subroot, digest("".join(own + top))))
    return root, sorted(out, key=str)


def built(spark, rows, every=merkle.EVERY, parts=5):
    ship(spark)
    made = merkle.manifest(spark.createDataFrame(rows, SCHEMA).repartition(parts), every=every)
    found = merkle.proofs(made)
    table = found.select("key", "digest", "subroot", merkle.proof_digest(F.col("path")).alias("p"),
                         merkle.folded(F.col("digest"), F.col("path")).alias("f")).collect()
    return made.root, table


def check(spark, rows, **options):
    root, found = built(spark, rows, **options)
    want_root, want = plain_manifest(rows)
    assert root == want_root
    assert {r["f"] for r in found} == {root}
    assert sorted(((r["key"], r["digest"], r["subroot"], r["p"]) for r in found), key=str) == want


@pytest.mark.parametrize("every", [1, 3])
@pytest.mark.parametrize("sizes", [[1], [16], [17, 1], [300, 2, 33]])
def test_sizes_of_groups(spark, sizes, every):
    rows = [(n * 1000 + i, f"s{n}", "en", i, f"text {i}") for n, size in enumerate(sizes) for i in range(size)]
    check(spark, rows, every=every)


def test_a_group_of_more_than_one_subtree(spark):
    check(spark, [(i, "hot", None, None, "x") for i in range(1200)] + [(-1, "other", None, None, "")], every=2)


def test_many_groups(spark):
    check(spark, [(i, f"s{i % 40}é{i % 3}", "en", 1, "x") for i in range(150)], every=1)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (None, None, None, None, None), (1, None, "en", 0, ""), (1, None, "en", 0, "b"), (1, None, "en", 0, "a"),
        (2, "", "é", -3, "ü" * 5000), (2, "", "é", -3, "ü" * 5000), (None, "-", "-", 7, "-"), (3, "z", None, None, "1:a"),
    ]
    check(spark, rows)
    check(spark, rows * 9, every=1, parts=3)


def test_layout_does_not_matter(spark):
    rows = [(i, f"s{i % 3}", "en", 1, f"t{i}") for i in range(100)]
    assert built(spark, rows, parts=1)[0] == built(spark, rows[::-1], parts=7)[0]


def test_empty_table_and_other_columns(spark):
    ship(spark)
    empty = spark.createDataFrame([], SCHEMA)
    made = merkle.manifest(empty)
    assert made.root is None and merkle.proofs(made).count() == 0
    clash = spark.createDataFrame([(5, "s", "en", 1, "x")], SCHEMA).selectExpr(
        "*", "1 AS key", "2 AS digest", "3 AS tree", "4 AS pos", "5 AS n", "6 AS path", "7 AS `group`", "8 AS tie"
    )
    made = merkle.manifest(clash, carry={"own": F.col("path") + 1})
    got = merkle.proofs(made).collect()
    assert [(r["key"], r["own"], r["digest"], r["path"]) for r in got] == [(5, 7, made.root, [])]


def test_only_every_third_level_is_stored(spark):
    ship(spark)
    docs = spark.range(5000).selectExpr("id AS doc_id", "'s' AS source", "'en' AS lang", "1L AS n_chars", "'t' AS text")
    made = merkle.manifest(docs)
    assert [level.count() for level in made.levels] == [5000, 2, 1]


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select(*merkle.FIELDS).collect()
    rows = {r["doc_id"]: r for r in QUERIES["op11_merkle"](spark, folder).collect()}
    root, want = plain_manifest([tuple(d) for d in docs])
    assert sorted(((r["doc_id"], r["leaf"], r["subroot"], r["proof_sha256"]) for r in rows.values()), key=str) == want
    for d in docs:
        touched = zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in d["text"])
        same = not touched or lowered == d["text"]
        row = rows[d["doc_id"]]
        assert row["root"] == root and row["verified"] == same == (row["folded_root"] == root)
    assert len({r["folded_root"] for r in rows.values()}) > 2
