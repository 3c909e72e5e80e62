from __future__ import annotations

from parcelscope.operators.joins import orphan_keys
from parcelscope.operators.references import Relation, orphans
from pyspark.sql import functions as F


def test_many_relations_in_two_exchanges(spark):
    child = spark.createDataFrame(
        [("a", 1), ("a", 1), ("x", 2), ("x", 3), ("y", None), (None, 1), (None, None)], "p string, q int"
    ).unionAll(spark.range(20_000).selectExpr("'hot' AS p", "7 AS q"))
    parents = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "key string")
    numbers = spark.createDataFrame([(1,), (3,)], "number int")
    empty = spark.createDataFrame([], "key string")
    relations = [
        Relation(child, "p", parents, "key"), Relation(child, "q", numbers, "number"), Relation(parents, "key", child, "p"),
        Relation(empty, "key", empty, "key"), Relation(child, "p", empty, "key"),
    ]
    found = orphans(relations)
    got = found.first()
    for k, r in enumerate(relations):
        plain = orphan_keys(r.child, r.column, r.parent, r.key)
        keyed = plain.where("orphan IS NOT NULL").agg(F.count("*"), F.coalesce(F.sum("n_rows"), F.lit(0))).first()
        nulls = r.child.where(F.col(r.column).isNull()).count()
        assert (got[f"keys_{k}"], got[f"rows_{k}"], got[f"nulls_{k}"]) == (*keyed, nulls), k
    assert (got["keys_0"], got["rows_0"], got["nulls_0"]) == (3, 20_003, 2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and "Join" not in plan


def test_every_table_is_read_once(spark, tmp_path):
    spark.range(10).selectExpr("id AS a", "id + 1 AS b", "id AS k").write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    found = orphans([Relation(t, "a", t, "k"), Relation(t, "b", t, "k")])
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert tuple(found.first()) == (0, 0, 0, 1, 1, 0)
