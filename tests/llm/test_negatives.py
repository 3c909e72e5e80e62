"""Mined negatives against all scores in memory."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelscope.llm import negatives
from parcelscope.llm.shipping import ship

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, is_anchor, positives=5, wanted=3):
    """The contract word by word; rows are told apart by their place."""
    sound = [
        (n, i, [math.floor(256 * float(np.float32(x))) for x in v], label)
        for n, (i, v, label) in enumerate(rows)
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, i, v, label in sound:
        if not is_anchor(i):
            continue
        others = [
            (-sum(a * b for a, b in zip(v, w)), j, other) for m, j, w, other in sound if m != n and len(w) == len(v)
        ]
        for ps, p, _ in sorted((x for x in others if x[2] == label), key=lambda x: x[:2])[:positives]:
            far = sorted(x[:2] for x in others if x[2] != label and 50 * -ps <= 100 * -x[0] <= 95 * -ps)
            out += [(i, p, rank, j, -ps, -ns) for rank, (ns, j) in enumerate(far[:wanted], 1)]
    return sorted(out)


def mined(spark, rows, **options):
    ship(spark)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = negatives.hard_negatives(df, F.col("vec_id") % 5 == 0, **options)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


def clusters(n, dim=6, kinds=8, seed=2, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(kinds, dim))
    which = rng.integers(kinds, size=n)
    x = centres[which] + spread * rng.normal(size=(n, dim))
    labels = np.where(rng.random(n) < 0.4, 0, which % 4)
    return [(i, [float(v) for v in x[i]], int(labels[i])) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"block": 4, "shard": 16, "group": 7, "sample": 50}])
def test_clusters(spark, options):
    rows = clusters(300)
    assert mined(spark, rows, **options) == plain(rows, lambda i: i % 5 == 0)


def test_odd_rows(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(4)], rng.randrange(3)) for i in range(60)]
    rows += [(60 + i, [1.0, 1.0], i % 2) for i in range(12)]  # another length, all ties
    rows += [(5, rows[5][1], rows[5][2]), (5, rows[5][1], rows[5][2])]  # repeated rows
    rows += [
        (None, [1.0] * 4, 1), (100, None, 1), (105, [1.0, None, 1.0, 1.0], 1), (110, [1.0, float("nan"), 1.0, 1.0], 1),
        (115, [float("inf"), 1.0, 1.0, 1.0], 1), (120, [1.0] * 4, None), (125, [], 0), (126, [], 0), (127, [], 1),
        (130, [0.0] * 4, 2), (135, [2e5] * 4, 0),
    ]
    got = mined(spark, rows, block=4, shard=8, group=3)
    assert got == plain(rows, lambda i: i % 5 == 0)
    assert any(g[0] == 125 for g in got)


def test_components_beyond_the_greatest_take_no_part(spark):
    rows = [(i, [1.0, 1.0], i % 2) for i in range(8)] + [(10, [1e30, 1.0], 0)]
    assert mined(spark, rows) == plain(rows[:-1], lambda i: i % 5 == 0)


def test_empty_table_and_other_columns(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(5, None, 1)]) == []
    ship(spark)
    rows = clusters(40)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS pos", "2 AS block", "3 AS id", "4 AS code", "5 AS anchor")
    found = negatives.hard_negatives(df, F.col("vec_id") % 5 == 0)
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, lambda i: i % 5 == 0)


def test_zone_maps_leave_blocks_out(spark):
    """On clustered vectors positives need few of their label's blocks."""
    ship(spark)
    rows = clusters(2000, kinds=16, spread=0.01)
    df = spark.createDataFrame([(i, v, 0) for i, v, _ in rows], SCHEMA)
    sound = negatives.codes(df, F.col("vec_id") % 50 == 0, 256, "vec_id", "embedding", "label")
    placed = negatives.ordered(sound, 32, negatives.DIRECTIONS, negatives.BITS, negatives.SAMPLE).cache()
    zones = negatives.zone_maps(placed).collect()
    assert len(zones) == math.ceil(2000 / 32)
    codes = {}
    for r in placed.collect():
        codes.setdefault(r["block"], []).append(r["code"])
    for z in zones:
        own = np.array(codes[z["block"]])
        assert z["low"] == own.min(axis=0).tolist() and z["high"] == own.max(axis=0).tolist()
    low, high = np.array([z["low"] for z in zones]), np.array([z["high"] for z in zones])
    anchors = np.array([r["code"] for r in placed.where("anchor").collect()])
    least, most = negatives.bounds(anchors, low, high)
    every = np.array([r["code"] for r in placed.collect()])
    score = negatives.scores(anchors, every)
    assert (most.max(axis=1) >= score.max(axis=1)).all() and (least.min(axis=1) <= score.min(axis=1)).all()
    fifth = np.partition(score, -6, axis=1)[:, -6]
    assert (most >= fifth[:, None]).mean() < 0.35
    placed.unpersist()


def test_hilbert_neighbours_are_one_step_apart():
    cells = np.array([[x, y, z] for x in range(8) for y in range(8) for z in range(8)])
    key = negatives.hilbert_key(cells, 3)
    assert sorted(key) == list(range(512))
    path = cells[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_scores_beyond_doubles_and_windows():
    a = np.array([[2**26, 2**26 - 1, 3]])
    assert negatives.scores(a, a)[0, 0] == 2**52 + (2**26 - 1) ** 2 + 9
    for s in (0, 1, 99, 100, 101, -7, -100, 2**62):
        low, high = negatives.windows(np.array([s]), (50, 95))
        assert int(low[0]) == -(-50 * s // 100) and int(high[0]) == 95 * s // 100
