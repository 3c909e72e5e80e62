from __future__ import annotations

import itertools
import uuid
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from parcelscope.operators import joins
from parcelscope.plans import history
from parcelscope.plans.history import apply_snapshot, as_of_join
from parcelscope.sources.lake import Lake

D = [date(2020, 1, 1), date(2020, 2, 1), date(2020, 3, 1), date(2020, 4, 1)]
SNAPSHOTS = {
    D[0]: [("a", "x", None), ("b", "y", 1), (None, "lost", 1)],
    D[1]: [("a", "x", None), ("b", "y", 2), ("c", "z", 1)],
    D[2]: [("a", "x", 0), ("b", "y", 1)],
    D[3]: [("a", "x", 0), ("b", "y", 1), ("c", "z", 1)],
}
WANT = [
    ("a", "x", None, D[0], D[2], False), ("a", "x", 0, D[2], None, True),
    ("b", "y", 1, D[0], D[1], False), ("b", "y", 2, D[1], D[2], False), ("b", "y", 1, D[2], None, True),
    ("c", "z", 1, D[1], D[2], False), ("c", "z", 1, D[3], None, True),
]
COLUMNS = ["id", "city", "n", "effective_start_date", "effective_end_date", "is_current"]


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"), prefix=f"h{uuid.uuid4().hex[:8]}_")


def take(lake, day, given=None):
    df = lake.spark.createDataFrame(SNAPSHOTS[day] if given is None else given, "id string, city string, n int")
    return apply_snapshot(lake, "members", df, day, "id", ["city", "n"])


@pytest.mark.parametrize("order", [[0, 1, 2, 3], [3, 2, 1, 0], [1, 3, 0, 2], [0, 0, 2, 3, 1, 2]])
def test_any_order_of_snapshots_gives_one_history(lake, order):
    for n in order:
        found = take(lake, D[n])
    assert rows(found, *COLUMNS) == sorted(WANT, key=str)
    assert found.select("version_key").distinct().count() == len(WANT)
    assert found.select("member_key").distinct().count() == 3


def test_a_corrected_snapshot_replaces_its_interval_only(lake):
    for day in D[:3]:
        take(lake, day)
    found = take(lake, D[1], [("a", "moved", None), ("b", "y", 1)])
    assert rows(found, *COLUMNS) == sorted(
        [
            ("a", "x", None, D[0], D[1], False), ("a", "moved", None, D[1], D[2], False), ("a", "x", 0, D[2], None, True),
            ("b", "y", 1, D[0], None, True),
        ],
        key=str,
    )
    assert rows(take(lake, D[2], []), "id", "is_current") == [("a", False), ("a", False), ("b", False)]


def test_closed_versions_pass_without_a_shuffle(lake):
    for day in D[:3]:
        take(lake, day)
    stored = lake.table("gold", "members").withColumn("effective_end_date", F.coalesce("effective_end_date", F.lit(history.OPEN)))
    snap = lake.spark.createDataFrame(SNAPSHOTS[D[3]], "id string, city string, n int")
    plan = history.overlay(stored.where("id IS NOT NULL"), snap, D[3], history.OPEN, "id", ["city", "n"])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    first = text.split("Aggregate")[0]
    assert text.lstrip().startswith("Union") and "Window" not in first


def test_facts_meet_the_version_of_their_day(lake, monkeypatch):
    for day in D:
        found = take(lake, day)
    days = [date(2019, 12, 31), D[0], date(2020, 1, 31), D[1], date(2020, 3, 15), D[3], None]
    facts = [(i, k, day) for i, (k, day) in enumerate(itertools.product(["a", "b", "c", "d", None], days))]
    facts += [(100 + i, "b", D[1]) for i in range(200)]  # a hot key
    df = lake.spark.createDataFrame(facts, "f int, id string, day date")

    def want(fact):
        held = [v for v in WANT if v[0] == fact[1] and fact[2] and v[3] <= fact[2] and (v[4] is None or fact[2] < v[4])]
        return (*fact, *(held[0][1:3] if held else (None, None)), held[0][3] if held else None)

    expected = sorted((want(f) for f in facts), key=str)
    columns = ["city", "n", "effective_start_date"]
    assert rows(as_of_join(df, found, "id", "day", columns, ["f"])) == expected
    # with the hot key spread over several tasks
    hot = joins.hot_keys
    monkeypatch.setattr(history, "hot_keys", lambda df, key, identity: hot(df, key, identity, hot_rows=20, one_in=1))
    spread = as_of_join(df, found, "id", "day", columns, ["f"])
    assert rows(spread) == expected
    assert "_salt" in spread._jdf.queryExecution().toString()
