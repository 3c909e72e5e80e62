"""Control tables: run log, high-water marks, quality log.

All three are append-only. A mark is moved by appending a later one; the current mark of a table is
its latest, so nothing needs UPDATE and a half-done job leaves no half-changed row.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelscope.plans.quality import stamped
from parcelscope.schemas import HIGH_WATER, QUALITY_LOG, RUN_LOG, SPECS
from parcelscope.sources.lake import Lake

LAYER = "ops"
# Run outcomes and the mark every table starts from.
SUCCESS, FAILED, DRIFTED = "success", "failed", "schema_drift"
FIRST_MARK = date(1900, 1, 1)


class Ledger:
    """The control tables of one lake."""

    def __init__(self, lake: Lake):
        self.lake = lake
        self.spark = lake.spark

    def create(self) -> Ledger:
        """Create what is missing and seed a first mark for tables that have none."""
        for table, schema in (
            ("run_log", RUN_LOG),
            ("high_water", HIGH_WATER),
            ("quality_log", QUALITY_LOG),
        ):
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.lake.name(LAYER, table)} ({columns}) "
                f"USING {self.lake.fmt} LOCATION '{self.lake.path(LAYER, table)}'"
            )
        seeds = self.spark.createDataFrame(
            [(name, FIRST_MARK, None) for name in SPECS], HIGH_WATER
        )
        missing = seeds.join(
            self._table("high_water").select("table_name"), "table_name", "left_anti"
        )
        self._append(missing.select(*HIGH_WATER.fieldNames()).coalesce(1), "high_water")
        return self

    def _table(self, table: str) -> DataFrame:
        return self.spark.table(self.lake.name(LAYER, table))

    def _append(self, df: DataFrame, table: str) -> None:
        df.write.mode("append").insertInto(self.lake.name(LAYER, table))

    # high-water marks

    def marks(self) -> DataFrame:
        return (
            self._table("high_water")
            .groupBy("table_name")
            .agg(
                F.max("last_loaded_date").alias("last_loaded_date"),
                F.max_by("last_run_id", "last_loaded_date").alias("last_run_id"),
            )
        )

    def mark(self, table: str) -> date:
        row = self.marks().where(F.col("table_name") == table).first()
        if row is None:
            raise ValueError(f"no high-water mark for table {table}")
        return row["last_loaded_date"]

    def move_mark(self, table: str, to: date, run_id: str) -> None:
        self._append(self._rows([(table, to, run_id)], HIGH_WATER), "high_water")

    # run log

    def log_run(
        self,
        run_id: str,
        table: str,
        source: str,
        rows: int,
        status: str,
        error: str | None = None,
    ) -> None:
        """Append one typed row, so an error text may contain anything."""
        entry = self._rows([(run_id, table, source, None, rows, status, error)], RUN_LOG)
        self._append(entry.withColumn("run_timestamp", F.current_timestamp()), "run_log")

    def runs(self, table: str | None = None) -> DataFrame:
        """The run report: a running number from the oldest run on, table, rows, status and time.

        The order of runs is data, as a DataFrame's order does not outlive a join. The window runs
        over the log, which has a row per table and run.
        """
        log = self._table("run_log")
        if table is not None:
            log = log.where(F.col("table_name") == table)
        oldest_first = Window.partitionBy(F.lit(0)).orderBy("run_timestamp", "run_id", "table_name")
        return log.select(
            F.row_number().over(oldest_first).alias("sequence"), "table_name", "rows_loaded", "status", "run_timestamp"
        ).orderBy("sequence")

    # quality log

    def log_quality(self, suite: DataFrame, run_id: str | None = None) -> DataFrame:
        """Append a suite's rows under a run id, a new one by default, and return that run's rows as
        stored."""
        run_id = run_id or uuid.uuid4().hex
        rows = stamped(suite).withColumn("run_id", F.lit(run_id))
        self._append(rows.select(*QUALITY_LOG.fieldNames()), "quality_log")
        return self._table("quality_log").where(F.col("run_id") == run_id)

    def log_cast_failures(self, table: str, counts: dict[str, int], run_id: str | None = None) -> None:
        rows = [
            (table, f"cast_{column}", f"{n} values did not parse", n == 0)
            for column, n in counts.items()
        ]
        if rows:
            schema = T.StructType(QUALITY_LOG.fields[:4])
            self.log_quality(self._rows(rows, schema), run_id)

    def log_broken_lines(self, table: str, n: int, run_id: str) -> None:
        if n:
            row = (table, "broken_lines", f"{n} lines with too many or too few fields", False)
            self.log_quality(self._rows([row], T.StructType(QUALITY_LOG.fields[:4])), run_id)

    def log_rejects(self, table: str, counts: dict[str, int], run_id: str) -> None:
        """How many rows a load left out, by reason."""
        rows = [(table, f"rejected_{why}", f"{n} rows left out", False) for why, n in counts.items() if n]
        if rows:
            self.log_quality(self._rows(rows, T.StructType(QUALITY_LOG.fields[:4])), run_id)

    def _rows(self, rows: Iterable[tuple], schema: T.StructType) -> DataFrame:
        """A handful of literal rows in one file."""
        return self.spark.createDataFrame(list(rows), schema).coalesce(1)
