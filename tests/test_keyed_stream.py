"""The keyed stream: repeats, late rows, replays, state."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from conftest import rows

from parcelscope.schemas import DATETIME, STRING, struct
from parcelscope.streaming.incremental import stream_files
from parcelscope.streaming.keyed import KeyedStream

SCHEMA = struct(("id", STRING), ("at", DATETIME), ("v", STRING))
DAY = datetime(2020, 1, 1)


def at(days):
    return None if days is None else DAY + timedelta(days=days)


@pytest.fixture
def stream(spark, tmp_path):
    keyed = KeyedStream(spark, str(tmp_path / "keyed"), SCHEMA, ("id",), "at", 10)

    def arrive(name, *given):
        data = [(k, at(days), name) for k, days in given]
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in" / name))

    def take(files_per_batch=None):
        return keyed.take(stream_files(spark, str(tmp_path / "in" / "*"), SCHEMA, files_per_batch=files_per_batch))

    return keyed, arrive, take


def test_repeats_late_rows_and_replays(stream):
    keyed, arrive, take = stream
    arrive("one", ("a", 0), ("b", 1), ("b", 1), (None, 2), ("x", None), (None, 2))
    take()
    arrive("two", ("a", 0), ("c", 15), ("b", 16))  # 'a' and 'b' again
    take()
    arrive("three", ("d", 6), ("e", 7), ("f", 30))  # 'd' is not after day 6, 'e' is
    take()
    want = [("a", at(0)), ("b", at(1)), ("c", at(15)), ("e", at(7)), ("f", at(30)), (None, at(2))]
    late = [("d", at(6), "late"), ("x", None, "undated")]
    assert rows(keyed.rows(), "id", "at") == want
    assert rows(keyed.late(), "id", "at", "reason") == late
    take()  # nothing new
    assert rows(keyed.rows(), "id", "at") == want
    assert rows(keyed.late(), "id", "at", "reason") == late


def test_a_key_may_come_again_after_the_delay(stream):
    keyed, arrive, take = stream
    arrive("one", ("a", 0), ("z", 40))
    take()
    arrive("two", ("a", 50))
    take()
    assert rows(keyed.rows(), "id", "at") == [("a", at(0)), ("a", at(50)), ("z", at(40))]


def test_state_is_bounded_by_the_delay(stream):
    keyed, arrive, take = stream
    arrive("one", *[(f"k{i}", 0) for i in range(500)])
    assert take().lastProgress["stateOperators"][0]["numRowsTotal"] == 500
    arrive("two", ("z", 100))
    assert take().lastProgress["stateOperators"][0]["numRowsTotal"] == 1


def test_batches_of_one_file_each_give_the_same(stream):
    keyed, arrive, take = stream
    for n in range(6):
        arrive(f"n{n}", (f"k{n}", n * 4), ("same", n * 4), (f"old{n}", n * 4 - 12))
    take(files_per_batch=1)
    assert keyed.marks().count() == 6
    found = rows(keyed.rows(), "id", "at")
    assert ("same", at(0)) in found and [f for f in found if f[0].startswith("k")] == [(f"k{n}", at(n * 4)) for n in range(6)]
    # behind the latest earlier day less ten, that is n * 4 - 14
    assert keyed.late().count() == 0


@pytest.mark.parametrize("step", ["_cut", "_pass_keys"])
def test_a_batch_that_died_is_run_again(stream, monkeypatch, step):
    keyed, arrive, take = stream
    arrive("one", ("a", 0), ("b", 20), ("c", None))
    take()
    arrive("two", ("a", 1), ("b", 21), ("d", 2), ("e", 22))
    whole = getattr(KeyedStream, step)

    def dies(self, *given):
        if step == "_cut":
            whole(self, *given)
        raise RuntimeError("lost")

    monkeypatch.setattr(KeyedStream, step, dies)
    with pytest.raises(Exception):
        take()
    monkeypatch.undo()
    take()
    assert rows(keyed.rows(), "id", "at") == [("a", at(0)), ("b", at(20)), ("e", at(22))]
    assert rows(keyed.late(), "id", "at", "reason") == [("a", at(1), "late"), ("c", None, "undated"), ("d", at(2), "late")]


def test_no_files(stream, spark, tmp_path):
    keyed, arrive, take = stream
    arrive("none")
    take()
    assert keyed.rows().count() == 0 and keyed.late().count() == 0
