from __future__ import annotations

import uuid
from datetime import date

import pytest
from conftest import rows, ts
from pyspark.sql import functions as F

from parcelscope.plans.calendar import calendar
from parcelscope.plans.control import Ledger
from parcelscope.plans.ingest import MODES, after_mark, bronze_table, full_load, incremental_load, rejects, rescued
from parcelscope.plans.pipeline import build_gold, build_silver, check_bronze, check_gold, check_silver
from parcelscope.schemas import BRONZE, SPECS
from parcelscope.settings import scratch_dir
from parcelscope.sources.extracts import SchemaDrift, find_drift, read_extract, typed
from parcelscope.sources.lake import Lake
from parcelscope.streaming.incremental import append_new, stream_extracts, stream_files

RUN_DAY = date(2026, 1, 1)
SELLERS = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
ORDERS = ",".join(BRONZE["orders"].fieldNames()) + "\n"


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"), prefix=f"t{uuid.uuid4().hex[:8]}_")


@pytest.fixture
def ledger(lake):
    return Ledger(lake).create()


@pytest.fixture
def extract(tmp_path):
    def write(text: str, name: str | None = None) -> str:
        path = tmp_path / (name or f"{uuid.uuid4().hex}.csv")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
        return str(path)

    return write


def order_line(order_id: str, bought: str) -> str:
    return f"{order_id},c{order_id},delivered,{bought},,,,\n"


def log(lake):
    return lake.table("ops", "run_log")


def test_full_load_replaces_and_registers(lake, ledger, extract):
    first = extract(SELLERS + "a,1,x,sp\nb,2,y,rj\n")
    second = extract(SELLERS + "c,3,z,mg\n")
    assert full_load(lake, ledger, "sellers", first, "r1", RUN_DAY).rows == 2
    assert full_load(lake, ledger, "sellers", second, "r2", RUN_DAY).rows == 1
    assert rows(bronze_table(lake, "sellers")) == [("c", 3, "z", "mg")]
    assert bronze_table(lake, "sellers").schema.simpleString() == BRONZE["sellers"].simpleString()
    assert rows(log(lake), "run_id", "table_name", "rows_loaded", "status", "error_message") == [
        ("r1", "sellers", 2, "success", None), ("r2", "sellers", 1, "success", None)
    ]
    assert ledger.mark("sellers") == RUN_DAY
    assert [r["table_name"] for r in ledger.runs("sellers").collect()] == ["sellers", "sellers"]


@pytest.mark.parametrize(
    "header, message",
    [
        ("seller_id,seller_zip_code_prefix,seller_city,seller_state,it's new",
         "header differs: undeclared columns [\"it's new\"], absent columns []"),
        ("seller_id,seller_zip_code_prefix,seller_city",
         "header differs: undeclared columns [], absent columns ['seller_state']"),
    ],
)
def test_drift_aborts_before_writing_and_is_logged(lake, ledger, extract, header, message):
    full_load(lake, ledger, "sellers", extract(SELLERS + "a,1,x,sp\n"), "r1", RUN_DAY)
    with pytest.raises(SchemaDrift):
        full_load(lake, ledger, "sellers", extract(header + "\nb,2,y,rj,q\n"), "r2", RUN_DAY)
    assert rows(bronze_table(lake, "sellers"), "seller_id") == [("a",)]
    assert rows(log(lake).where("run_id = 'r2'"), "rows_loaded", "status", "error_message") == [
        (0, "schema_drift", message)
    ]


def test_reordered_columns_keep_their_values(lake, ledger, extract):
    moved = extract("seller_state,seller_id,seller_city,seller_zip_code_prefix\nsp,a,x,1\n")
    full_load(lake, ledger, "sellers", moved, "r1", RUN_DAY)
    assert rows(bronze_table(lake, "sellers")) == [("a", 1, "x", "sp")]


def test_a_file_with_another_header_fails_the_folder(spark, lake, ledger, extract, tmp_path):
    extract(SELLERS + "a,1,x,sp\n", "mixed/1.csv")
    extract("seller_state,seller_id,seller_city,seller_zip_code_prefix\nrj,b,y,2\n", "mixed/2.csv")
    with pytest.raises(Exception):
        full_load(lake, ledger, "sellers", str(tmp_path / "mixed"), "r1", RUN_DAY)
    assert rows(log(lake), "status") == [("failed",)]


def test_values_that_do_not_parse_become_null_and_are_counted(lake, ledger, extract):
    full_load(lake, ledger, "sellers", extract(SELLERS + "a,one,x,sp\nb,12.0,y,rj\n"), "r1", RUN_DAY)
    assert rows(bronze_table(lake, "sellers"), "seller_zip_code_prefix") == [(12,), (None,)]
    assert rows(lake.table("ops", "quality_log"), "table_name", "check_type", "result", "passed") == [
        ("sellers", "cast_seller_zip_code_prefix", "1 values did not parse", False)
    ]


def test_quoted_line_break_is_one_record(spark, extract):
    head = ",".join(BRONZE["order_reviews"].fieldNames())
    path = extract(head + '\nr1,o1,5,,"two\nlines, ""quoted""",2018-01-01,2018-01-02 03:04:05\n')
    spec = SPECS["order_reviews"]
    got = typed(read_extract(spark, path, spec.multi_line), spec.schema)
    assert rows(got, "review_comment_message", "review_answer_timestamp") == [
        ('two\nlines, "quoted"', ts("2018-01-02 03:04:05"))
    ]
    assert [s.name for s in SPECS.values() if s.multi_line] == ["order_reviews"]


def test_drift_is_a_set_difference():
    drift = find_drift(["seller_id", "x"], BRONZE["sellers"])
    assert drift.unexpected == ("x",)
    assert drift.missing == ("seller_zip_code_prefix", "seller_city", "seller_state")
    assert not find_drift(BRONZE["sellers"].fieldNames(), BRONZE["sellers"])


def test_incremental_load_takes_rows_after_the_mark(lake, ledger, extract):
    one = extract(ORDERS + order_line("1", "2017-01-01 10:00:00") + order_line("2", "2017-01-02 23:59:59"))
    assert incremental_load(lake, ledger, "orders", one, "r1", RUN_DAY).rows == 2
    assert ledger.mark("orders") == date(2017, 1, 2)
    two = extract(
        ORDERS
        + order_line("1", "2017-01-01 10:00:00") + order_line("2", "2017-01-02 23:59:59")
        + order_line("3", "2017-01-02 12:00:00")  # on the mark: not after it
        + order_line("4", "2017-01-03 00:00:00") + order_line("5", "")
    )
    assert incremental_load(lake, ledger, "orders", two, "r2", RUN_DAY, mode="event_date").rows == 1
    assert rows(bronze_table(lake, "orders"), "order_id") == [("1",), ("2",), ("4",)]
    assert incremental_load(lake, ledger, "orders", two, "r3", RUN_DAY, mode="event_date").rows == 0
    assert ledger.mark("orders") == date(2017, 1, 3)
    assert bronze_table(lake, "orders").count() == 3


def test_late_rows_and_the_rest_of_the_marks_day_are_loaded(lake, ledger, extract):
    first = ORDERS + order_line("1", "2017-01-01 08:00:00")
    incremental_load(lake, ledger, "orders", extract(first), "r1", RUN_DAY)
    more = first + order_line("2", "2017-01-01 20:00:00") + order_line("3", "2016-12-31") + order_line("4", "2017-01-02")
    assert incremental_load(lake, ledger, "orders", extract(more), "r2", RUN_DAY).rows == 3
    assert incremental_load(lake, ledger, "orders", extract(more), "r3", RUN_DAY).rows == 0
    old = more + order_line("5", "2016-01-01")  # before the lookback
    assert incremental_load(lake, ledger, "orders", extract(old), "r4", RUN_DAY).rows == 0
    assert incremental_load(lake, ledger, "orders", extract(old), "r5", RUN_DAY, lookback_days=400).rows == 1
    assert rows(bronze_table(lake, "orders"), "order_id") == [(str(i),) for i in range(1, 6)]
    assert ledger.mark("orders") == date(2017, 1, 2)


def test_rows_older_than_the_lookback_are_rejected_as_late(lake, ledger, extract):
    first = ORDERS + order_line("1", "2016-06-01") + order_line("2", "2017-01-01")
    incremental_load(lake, ledger, "orders", extract(first), "r1", RUN_DAY)
    more = extract(first + order_line("3", "2016-12-01") + order_line("4", "2016-12-28"))
    for run in ("r2", "r3"):
        incremental_load(lake, ledger, "orders", more, run, RUN_DAY)
    assert rows(bronze_table(lake, "orders"), "order_id") == [("1",), ("2",), ("4",)]
    assert rows(rejects(lake, "orders"), "order_id", "reason") == [("3", "late")]
    logged = lake.table("ops", "quality_log").where("check_type = 'rejected_late'")
    assert rows(logged, "run_id", "result", "passed") == [("r2", "1 rows left out", False), ("r3", "1 rows left out", False)]
    assert incremental_load(lake, ledger, "orders", more, "r4", RUN_DAY, lookback_days=60).rows == 1
    assert rows(bronze_table(lake, "orders"), "order_id") == [(str(i),) for i in range(1, 5)]
    assert ledger.mark("orders") == date(2017, 1, 1)


def test_undated_and_future_rows_are_kept_apart_and_never_move_the_mark(lake, ledger, extract):
    source = extract(ORDERS + order_line("1", "2017-01-01") + order_line("2", "2999-01-01") + order_line("3", ""))
    for run in ("r1", "r2"):
        incremental_load(lake, ledger, "orders", source, run, RUN_DAY)
    assert ledger.mark("orders") == date(2017, 1, 1)
    assert rows(bronze_table(lake, "orders"), "order_id") == [("1",)]
    assert rows(rejects(lake, "orders"), "order_id", "reason") == [("2", "future"), ("3", "undated")]
    logged = lake.table("ops", "quality_log").where("run_id = 'r1' AND check_type LIKE 'rejected%'")
    assert rows(logged, "check_type", "result", "passed") == [
        ("rejected_future", "1 rows left out", False), ("rejected_undated", "1 rows left out", False)
    ]
    later = extract(ORDERS + order_line("4", "2017-01-02"))
    assert incremental_load(lake, ledger, "orders", later, "r3", RUN_DAY).rows == 1


def test_a_quality_run_returns_its_own_rows(spark, lake, ledger):
    suite = lambda passed: spark.createDataFrame(
        [("t", "c", "x", passed)], "table_name string, check_type string, result string, passed boolean"
    )
    assert rows(ledger.log_quality(suite(False)), "passed") == [(False,)]
    assert rows(ledger.log_quality(suite(True)), "passed") == [(True,)]
    assert lake.table("ops", "quality_log").count() == 2


def test_run_report_is_numbered(lake, ledger, extract):
    for run in ("r2", "r1", "r3"):
        full_load(lake, ledger, "sellers", extract(SELLERS + "a,1,x,sp\n"), run, RUN_DAY)
    assert [r["sequence"] for r in ledger.runs().collect()] == [1, 2, 3]


def test_scratch_needs_a_shared_folder():
    class Session:
        def __init__(self, **conf):
            self.conf = conf

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,512]"):
        with pytest.raises(ValueError):
            scratch_dir(Session(**{"spark.master": master}), "x")
    shared = Session(**{"spark.master": "yarn", "spark.checkpoint.dir": "hdfs://x/"})
    assert scratch_dir(shared, "x").startswith("hdfs://x/parcelscope/x-")


def test_stream_counts_more_batches_than_a_session_keeps(spark, tmp_path):
    folder, base = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(30).repartition(12).write.parquet(folder)
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    try:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 3)
        files = stream_files(spark, folder, spark.range(1).schema, files_per_batch=1)
        assert append_new(files.where("id < 20"), f"{base}/t", f"{base}/c") == 20
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)


def test_run_date_mode_skips_late_rows_and_event_date_mode_does_not(lake, ledger, extract):
    first = extract(ORDERS + order_line("1", "2017-01-01"))
    late = extract(ORDERS + order_line("1", "2017-01-01") + order_line("2", "2017-06-01"))
    incremental_load(lake, ledger, "orders", first, "r1", RUN_DAY, mode="run_date")
    assert ledger.mark("orders") == RUN_DAY
    assert incremental_load(lake, ledger, "orders", late, "r2", RUN_DAY, mode="run_date").rows == 0
    other = Ledger(Lake(lake.spark, lake.root + "_b", prefix=lake.prefix + "b_")).create()
    incremental_load(other.lake, other, "orders", first, "r1", RUN_DAY)
    assert incremental_load(other.lake, other, "orders", late, "r2", RUN_DAY).rows == 1
    with pytest.raises(ValueError):
        incremental_load(lake, ledger, "orders", first, "r3", RUN_DAY, mode="whenever")


@pytest.mark.parametrize("mode", MODES)
def test_loads_that_bring_nothing_new(lake, ledger, extract, mode):
    """The mark equals the run's day, the extract is the same, older or empty."""
    day = date(2017, 1, 1)
    first = extract(ORDERS + order_line("1", "2017-01-01 10:00:00"))
    assert incremental_load(lake, ledger, "orders", first, "r1", day, mode=mode).rows == 1
    assert ledger.mark("orders") == day
    for run, text in (("r2", order_line("1", "2017-01-01 10:00:00")), ("r3", order_line("1", "2016-01-01")), ("r4", "")):
        load = incremental_load(lake, ledger, "orders", extract(ORDERS + text), run, day, mode=mode)
        assert (load.rows, load.mark) == (0, day)
    assert rows(log(lake), "run_id", "rows_loaded", "status") == [
        ("r1", 1, "success"), ("r2", 0, "success"), ("r3", 0, "success"), ("r4", 0, "success")
    ]
    assert rows(bronze_table(lake, "orders"), "order_id") == [("1",)]


def test_what_does_not_read_is_kept_as_it_came(lake, ledger, extract):
    lines = ["a,one,x,sp", "b,2", "c,3,z,mg,more", 'd,4,"z,mg', "e,5,z,mg", "f,VI"]
    source = extract(SELLERS + "\n".join(lines) + "\n")
    assert full_load(lake, ledger, "sellers", source, "r1", RUN_DAY).rows == 6
    assert rows(bronze_table(lake, "sellers"), "seller_id", "seller_zip_code_prefix", "seller_state") == [
        ("a", None, "sp"), ("b", 2, None), ("c", 3, "mg"), ("d", 4, None), ("e", 5, "mg"), ("f", None, None)
    ]
    assert rows(rescued(lake, "sellers"), "run_id", "line", "column", "raw_value") == [
        ("r1", "a,one,x,sp", "seller_zip_code_prefix", "one"), ("r1", "b,2", None, None),
        ("r1", "c,3,z,mg,more", None, None), ("r1", 'd,4,"z,mg', None, None),
        ("r1", "f,VI", "seller_zip_code_prefix", "VI"),
    ]
    assert rows(lake.table("ops", "quality_log"), "check_type", "result") == [
        ("broken_lines", "3 lines with too many or too few fields"),
        ("cast_seller_zip_code_prefix", "2 values did not parse"),
    ]


def test_incremental_load_keeps_raw_values(lake, ledger, extract):
    text = "1,c1,delivered,2017-01-01,soon,,,\n2,c2,delivered,yesterday,,,,\n"
    incremental_load(lake, ledger, "orders", extract(ORDERS + text), "r1", RUN_DAY)
    assert rows(rescued(lake, "orders"), "order_id", "column", "raw_value") == [
        ("1", "order_approved_at", "soon"), ("2", "order_purchase_timestamp", "yesterday")
    ]
    assert rows(bronze_table(lake, "orders"), "order_id", "order_approved_at") == [("1", None)]
    assert rows(rejects(lake, "orders"), "order_id", "reason") == [("2", "undated")]


def test_rerun_after_a_crash_before_the_mark_moved(lake, ledger, extract, monkeypatch):
    source = extract(ORDERS + order_line("1", "2017-01-01") + order_line("2", "2017-01-02"))

    def crash(*_):
        raise RuntimeError("lost the driver's connection: 'bye'")

    monkeypatch.setattr(Ledger, "move_mark", crash)
    with pytest.raises(RuntimeError):
        incremental_load(lake, ledger, "orders", source, "r1", RUN_DAY)
    monkeypatch.undo()
    assert rows(log(lake), "status", "error_message") == [
        ("failed", "lost the driver's connection: 'bye'")
    ]
    incremental_load(lake, ledger, "orders", source, "r2", RUN_DAY)
    assert rows(bronze_table(lake, "orders"), "order_id") == [("1",), ("2",)]


def test_incremental_load_by_month_prunes(lake, ledger, extract):
    source = extract(ORDERS + order_line("1", "2017-01-01") + order_line("2", "2017-02-02"))
    incremental_load(lake, ledger, "orders", source, "r1", RUN_DAY, by_month=True)
    more = extract(ORDERS + order_line("3", "2018-02-02"))
    incremental_load(lake, ledger, "orders", more, "r2", RUN_DAY, by_month=True)
    table = lake.table("bronze", "orders").where("event_year = 2017 AND event_month = 2")
    assert rows(table, "order_id") == [("2",)]
    assert "PartitionFilters: [isnotnull(event_year" in table._jdf.queryExecution().toString()
    assert bronze_table(lake, "orders").count() == 3


def test_after_mark_equals_the_date_comparison(spark):
    df = spark.createDataFrame(
        [(ts(t),) for t in ("2017-01-01 23:59:59", "2017-01-02", "2017-01-02 00:00:01", None)],
        "t timestamp_ntz",
    )
    mark = date(2017, 1, 1)
    assert rows(df.where(after_mark("t", mark))) == rows(
        df.where(F.to_date("t") > F.lit(mark))
    ) == [(ts("2017-01-02"),), (ts("2017-01-02 00:00:01"),)]


def test_marks_need_a_table(ledger):
    with pytest.raises(ValueError):
        ledger.mark("nothing")


def test_creating_the_control_tables_again_keeps_the_marks(lake, ledger):
    ledger.move_mark("orders", date(2018, 1, 1), "r1")
    again = Ledger(lake).create()
    assert again.mark("orders") == date(2018, 1, 1)
    assert again.mark("sellers") == date(1900, 1, 1)
    assert lake.table("ops", "high_water").count() == len(SPECS) + 1
    assert rows(again.marks().where("table_name = 'orders'"), "last_run_id") == [("r1",)]


def test_partitioned_refresh_prunes(lake, ledger, extract):
    head = ",".join(BRONZE["geolocation"].fieldNames()) + "\n"
    full_load(lake, ledger, "geolocation", extract(head + "1,1.5,2.5,x,SP\n2,3,4,y,RJ\n"), "r1", RUN_DAY)
    full_load(lake, ledger, "geolocation", extract(head + "3,1.5,2.5,x,SP\n2,3,4,y,MG\n"), "r2", RUN_DAY)
    table = bronze_table(lake, "geolocation")
    assert rows(table, "geolocation_zip_code_prefix", "geolocation_state") == [(2, "MG"), (3, "SP")]
    plan = table.where("geolocation_state = 'SP'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(geolocation_state" in plan


def test_refresh_may_read_the_table_it_replaces(spark, lake):
    lake.refresh(spark.range(3), "silver", "t")
    grown = lake.refresh(lake.table("silver", "t").union(spark.range(3, 5)), "silver", "t")
    assert rows(grown) == [(0,), (1,), (2,), (3,), (4,)]
    wider = lake.refresh(grown.withColumn("y", F.lit(1)), "silver", "t")
    assert wider.columns == ["id", "y"] and wider.count() == 5


@pytest.mark.parametrize("layout", [{}, {"partition_by": ("k",)}, {"bucket_by": (2, "id")}])
def test_a_failed_refresh_leaves_the_old_rows(spark, lake, layout):
    good = spark.range(4).withColumn("k", F.col("id") % 2)
    lake.refresh(good, "gold", "t", **layout)
    bad = good.withColumn("id", F.when(F.col("id") == 3, F.raise_error(F.lit("lost")).cast("long")).otherwise(7))
    with pytest.raises(Exception, match="lost"):
        lake.refresh(bad.withColumn("more", F.lit(1)), "gold", "t", **layout)
    assert rows(lake.table("gold", "t").select("id")) == [(0,), (1,), (2,), (3,)]
    lake.refresh(good.where("id < 2"), "gold", "t", **layout)
    assert rows(lake.table("gold", "t").select("id")) == [(0,), (1,)]


def test_old_versions_go_only_when_asked(spark, lake):
    for n in (1, 2, 3):
        lake.refresh(spark.range(n), "silver", "t")
    assert lake.drop_old_versions("silver", "t") == 2
    assert lake.drop_old_versions("silver", "t") == 0
    spark.catalog.refreshTable(lake.name("silver", "t"))
    assert lake.table("silver", "t").count() == 3


def test_bucketed_refresh_joins_without_a_shuffle(spark, lake):
    a = lake.refresh(spark.range(100), "gold", "a", bucket_by=(4, "id"))
    b = lake.refresh(spark.range(50), "gold", "b", bucket_by=(4, "id"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        joined = a.join(b, "id")
        assert joined.count() == 50
        assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_path_and_managed_sinks(spark, lake):
    lake.append(spark.range(2), "bronze", "p")
    lake.append(spark.range(2), "bronze", "p")
    assert lake.load("bronze", "p").count() == 4
    lake.overwrite(spark.range(3).withColumn("k", F.lit("x")), "bronze", "q", ("k",))
    lake.overwrite(spark.range(1).withColumn("k", F.lit("x")), "bronze", "q", ("k",))
    lake.register("bronze", "q")
    lake.register("bronze", "q")
    assert rows(lake.table("bronze", "q")) == [(0, "x")]
    assert lake.save_managed(spark.range(7), "silver", "m").count() == 7
    assert lake.save_managed(spark.range(2), "silver", "m").count() == 2


def test_event_stream_takes_every_file_once(spark, tmp_path):
    folder, base = str(tmp_path / "in"), str(tmp_path / "out")
    df = spark.range(5).withColumn("v", F.lit("x"))
    df.write.parquet(folder)
    run = lambda: append_new(
        stream_files(spark, folder, df.schema), f"{base}/t", f"{base}/c"
    )
    assert (run(), run()) == (5, 0)
    spark.range(5, 7).withColumn("v", F.lit("y")).write.mode("append").parquet(folder)
    assert run() == 2
    assert rows(spark.read.parquet(f"{base}/t"), "id") == [(i,) for i in range(7)]


def test_extract_stream_gates_and_types(spark, extract, tmp_path):
    extract(SELLERS + "a,1,x,sp\n", "s/1.csv")
    base = str(tmp_path / "out")
    spec = SPECS["sellers"]
    run = lambda: append_new(
        stream_extracts(spark, str(tmp_path / "s"), spec), f"{base}/t", f"{base}/c"
    )
    assert run() == 1
    extract(SELLERS + "b,2,y,rj\n", "s/2.csv")
    assert run() == 1
    assert rows(spark.read.parquet(f"{base}/t")) == [("a", 1, "x", "sp"), ("b", 2, "y", "rj")]
    extract("seller_id,other\nc,2\n", "d/1.csv")
    with pytest.raises(SchemaDrift):
        stream_extracts(spark, str(tmp_path / "d"), spec)


def test_pipeline_end_to_end(spark, lake, ledger, extract):
    def source(table, *lines):
        return extract(",".join(BRONZE[table].fieldNames()) + "\n" + "".join(x + "\n" for x in lines))

    sources = {
        "order_items": source("order_items", "o1,1,p1,s1,2017-01-05,10.00,2.00", "o1,2,p1,s1,2017-01-05,5.00,1.00"),
        "order_payments": source("order_payments", "o1,1,boleto,1,18.00"),
        "customers": source("customers", "c1,u1,100,x,sp"),
        "sellers": source("sellers", "s1,100,x,sp"),
        "products": source("products", "p1,livros,1,2,3,4,5,6,7"),
        "product_category_translation": source("product_category_translation", "livros,books"),
        "geolocation": source("geolocation", "100,-1.0,2.0,x,SP"),
    }
    for table, path in sources.items():
        full_load(lake, ledger, table, path, "r1", RUN_DAY)
    orders = source("orders", "o1,c1,delivered,2017-01-01 10:00:00,,,2017-01-04 09:00:00,2017-01-10")
    reviews = source("order_reviews", "r1,o1,5,,fine,2017-01-05,2017-01-06 01:00:00")
    incremental_load(lake, ledger, "orders", orders, "r1", RUN_DAY)
    incremental_load(lake, ledger, "order_reviews", reviews, "r1", RUN_DAY)
    build_silver(lake)
    gold = build_gold(lake, calendar(spark, date(2016, 1, 1), date(2018, 12, 31), RUN_DAY))
    build_gold(lake, calendar(spark, date(2016, 1, 1), date(2018, 12, 31), RUN_DAY))  # again
    assert rows(gold["fact_orders"], "order_item_id", "payment_value", "review_score", "delivery_days") == [
        (1, 18, 5, 2), (2, 18, 5, 2)
    ]
    counts = {t: 1 for t in SPECS} | {"order_items": 2}
    check_bronze(lake, ledger, counts)
    check_silver(lake, ledger)
    logged = check_gold(lake, ledger)
    failed = logged.where(~F.col("passed"))
    assert rows(failed, "table_name", "check_type", "result") == []
    assert logged.where(F.col("run_timestamp").isNull()).count() == 0
    assert all(lake.exists("bronze", t) for t in SPECS)
