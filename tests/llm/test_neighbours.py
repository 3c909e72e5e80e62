"""Multi-index hashing: exact within its radius, and recall against brute force."""

from __future__ import annotations

import numpy as np
import pyarrow.parquet as pq
import pytest

from parcelscope.llm import neighbours
from parcelscope.llm.shipping import ship
from parcelscope.llm.suite import QUERIES

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("bits,n,radius", [(64, 3000, 20), (64, 40, 9), (10, 500, 3), (64, 2000, 0), (7, 9, 7), (1, 5, 0)])
def test_probing_finds_every_code_of_the_radius(bits, n, radius):
    rng = np.random.default_rng(bits + n)
    codes = rng.integers(0, 1 << bits, n, dtype=np.uint64, endpoint=False)
    codes[: n // 3] = codes[0]
    index = neighbours.Substrings(codes, bits, radius)
    for code in [*codes[:3], *rng.integers(0, 1 << bits, 20, dtype=np.uint64)]:
        want = np.flatnonzero(np.bitwise_count(codes ^ code) <= radius)
        assert (index.within(code) == want).all()


def brute(ids, vectors, k=5, every=50):
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    found = set()
    for q in np.flatnonzero(ids % every == 0):
        score = units @ units[q]
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[q]][:k]
        found |= {(int(ids[q]), int(ids[i])) for i in order}
    return found


def test_recall(spark):
    data = pq.read_table(f"{FOLDER}/embeddings.parquet")
    vectors = np.stack(data.column("embedding").to_pylist()).astype(float)
    ids = data.column("vec_id").to_numpy()
    rows = QUERIES["op2_neighbours"](spark, FOLDER).collect()
    want = brute(ids, vectors)
    assert len(want & {(r["query_id"], r["vec_id"]) for r in rows}) >= 0.9 * len(want)
    assert len(rows) == len(want)
    at = {v: i for i, v in enumerate(ids)}
    for r in rows:
        a, b = vectors[at[r["query_id"]]], vectors[at[r["vec_id"]]]
        assert r["score"] == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-12)
    for q in {r["query_id"] for r in rows}:
        own = sorted((r for r in rows if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, len(own) + 1))
        assert own == sorted(own, key=lambda r: (-r["score"], r["vec_id"]))


def test_few_and_invalid_vectors(spark):
    ship(spark)
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (1, [1.0, 0.1], 1), (2, [2.0, 0.2], 1), (3, [-1.0, 0.0], 1), (50, [0.0, 3e38], None),
        (4, None, 1), (5, [], 1), (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [1.0], 1), (None, [1.0, 1.0], 1),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS code", "2 AS place")
    got = {}
    for r in neighbours.nearest(frame).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert {q: [v for _, v in sorted(x)] for q, x in got.items()} == {0: [1, 2, 50, 3], 50: [1, 2, 0, 3]}
    assert neighbours.nearest(frame.limit(0)).count() == 0


def test_copies_tie_to_the_smaller_id(spark):
    ship(spark)
    rows = [(i, [0.3, 0.4, 0.5] if i % 3 else [float(i + 1), 1.0, -2.0], 0) for i in range(300)]
    got = neighbours.nearest(spark.createDataFrame(rows, SCHEMA)).where("query_id = 50").orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [1, 2, 4, 5, 7]
