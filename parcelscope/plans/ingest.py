"""Bronze loads: drift gate, one pass over the extract, run log, high-water mark.

Both load kinds can be rerun after a crash at any point:

- a full load writes a new version and then points the table at it; its counts are observed on that
  write;
- an incremental load writes the typed rows of its extract to the shared scratch folder, counts and
  splits them there, writes into a partition of its own run and leaves out rows whose keys are
  stored already, so a rerun adds what is missing, or replaces its partition under the same run id.

Rows that a load does not place, those without an event time, dated after the run, or older than it
takes and not stored, go to a table of rejects, are counted in the quality log, and never move the
mark. Values that do not parse and lines with too many or too few fields are stored as they came.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta
from functools import reduce
from operator import and_
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F

from parcelscope.plans.control import DRIFTED, FAILED, FIRST_MARK, SUCCESS, Ledger
from parcelscope.schemas import DATETIME, SPECS, TableSpec
from parcelscope.settings import staged
from parcelscope.sources.extracts import LINE, RESCUED, SchemaDrift, parsed, read_lines
from parcelscope.sources.lake import Lake

LAYER = "bronze"
RUN = "load_run"
REJECTS, RESCUES = "_rejects", "_rescued_lines"
LOOKBACK_DAYS = 7
MODES = ("lookback", "event_date", "run_date")


def after_mark(column: str, mark: date) -> Column:
    """Event date strictly after the mark; a null event time is not.

    Written as a range on the bare column, equal to ``to_date(column) > mark``, so that Parquet
    sources skip row groups.
    """
    next_day = datetime.combine(mark + timedelta(days=1), time())
    return F.col(column) >= F.lit(next_day).cast(DATETIME)


@dataclass(frozen=True)
class Load:
    """What a load did. ``mark`` is the table's high-water mark afterwards."""

    table: str
    rows: int
    mark: date | None


def _bad_counts(metrics: dict) -> dict[str, int]:
    return {k.removeprefix("bad_"): v for k, v in metrics.items() if k.startswith("bad_") and v}


def full_load(
    lake: Lake, ledger: Ledger, table: str, source: str | list[str], run_id: str, run_date: date
) -> Load:
    """Replace a bronze table by its extract."""
    spec = SPECS[table]
    label = source if isinstance(source, str) else ",".join(source)
    with _logged(ledger, run_id, table, label):
        lines = parsed(read_lines(lake.spark, source, spec), spec.schema)
        counts = Observation()
        rows = lines.observe(counts, F.count(F.lit(1)).alias("n"), *_reading_counts(spec))
        lake.refresh(rows.select(*spec.schema.fieldNames()), LAYER, table, spec.partition_by)
        seen = Row(**counts.get)
        _keep_rescued(lake, table, run_id, lines, seen)  # a second read, where there is something
        ledger.move_mark(table, run_date, run_id)
        _log_reading(ledger, table, seen, run_id)
        ledger.log_run(run_id, table, label, seen["n"], SUCCESS)
    return Load(table, seen["n"], run_date)


def incremental_load(
    lake: Lake,
    ledger: Ledger,
    table: str,
    source: str | list[str],
    run_id: str,
    run_date: date,
    mode: str = "lookback",
    by_month: bool = False,
    lookback_days: int = LOOKBACK_DAYS,
) -> Load:
    """Append the extract's rows that are not stored yet.

    ``mode='lookback'`` takes rows dated from ``lookback_days`` before the mark on, so rows of the
    mark's own day and rows delivered late are picked up. ``'event_date'`` takes rows dated after the
    mark's day only. Both move the mark to the latest event date seen. ``'run_date'`` takes the same
    rows as ``'event_date'`` and moves the mark to the day of the run. No mode moves it beyond the
    run's day. In every mode a row whose key is stored already is left out, and an older row whose
    key is not stored is rejected as ``late``; a load with more ``lookback_days`` takes it.

    ``by_month`` lays the rows out by event year and month; it must not change during a table's
    life. ``run_id`` names the partition a run writes; a repeated id replaces it.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    spec = SPECS[table]
    event = spec.event_column
    label = source if isinstance(source, str) else ",".join(source)
    mark = ledger.mark(table)
    last_seen = mark - timedelta(days=lookback_days + 1) if mode == "lookback" and mark > FIRST_MARK else mark
    early, late = after_mark(event, last_seen), F.to_date(event) > F.lit(run_date)
    older = F.col(event).isNotNull() & ~early & ~late
    with _logged(ledger, run_id, table, label):
        lines = parsed(read_lines(lake.spark, source, spec), spec.schema)
        # written once: what follows counts and splits the same typed rows, and reads no text again
        given = staged(lines, f"load-{table}")
        seen = given.agg(
            F.count_if(F.col(event).isNull()).alias("undated"),
            F.count_if(late).alias("future"),
            F.count_if(older).alias("older"),
            F.max(F.when(early & ~late, F.to_date(event))).alias("latest"),
            *_reading_counts(spec),
        ).first()
        columns = spec.schema.fieldNames()
        rows = _not_stored(lake, table, run_id, given.where(early & ~late).select(*columns), early)
        months = {"event_year": F.year(event), "event_month": F.month(event)} if by_month else {}
        count = _write_run(lake, rows.withColumns(months), table, run_id, tuple(months))
        behind = _not_stored(lake, table, run_id, given.where(older).select(*columns), F.lit(True))
        rejected = {
            "undated": seen["undated"],
            "future": seen["future"],
            "late": behind.count() if seen["older"] else 0,
        }
        if any(rejected.values()):
            why = F.when(F.col(event).isNull(), "undated").when(late, "future").otherwise("late")
            out = given.where(F.col(event).isNull() | late).select(*columns)
            if rejected["late"]:
                out = out.unionByName(behind)
            out = _not_stored(lake, f"{table}{REJECTS}", run_id, out, F.lit(True), columns)
            _write_run(lake, out.withColumn("reason", why), f"{table}{REJECTS}", run_id, ())
        _keep_rescued(lake, table, run_id, given, seen)
        new_mark = run_date if mode == "run_date" else seen["latest"]
        if new_mark is not None and new_mark > mark:
            ledger.move_mark(table, new_mark, run_id)
        _log_reading(ledger, table, seen, run_id)
        ledger.log_rejects(table, rejected, run_id)
        ledger.log_run(run_id, table, label, count, SUCCESS)
    return Load(table, count, max(mark, new_mark or mark))


def _not_stored(
    lake: Lake, table: str, run_id: str, rows: DataFrame, in_range: Column, key: list[str] | None = None
) -> DataFrame:
    """``rows`` without those whose key (null being a value) another run stored."""
    if not lake.exists(LAYER, table):
        return rows
    key = list(key or SPECS[table].row_key)
    stored = lake.table(LAYER, table).where((F.col(RUN) != run_id) & in_range).select(key)
    same = [rows[c].eqNullSafe(stored[c]) for c in key]
    return rows.join(stored, reduce(and_, same), "left_anti")


def _write_run(lake: Lake, rows: DataFrame, table: str, run_id: str, partition_by: tuple[str, ...]) -> int:
    """Write a run's partition and return its number of rows, from the files that are there.

    Counted after the write, not observed on it: where a filter can hold for no row, the optimizer
    leaves out the plan below it, and with it any observation.
    """
    path = f"{lake.path(LAYER, table)}/{RUN}={quote(run_id, safe='-_.')}"
    rows.write.format(lake.fmt).mode("overwrite").partitionBy(*partition_by).save(path)
    lake.register(LAYER, table)
    lake.spark.catalog.refreshTable(lake.name(LAYER, table))
    return lake.spark.read.format(lake.fmt).schema(rows.schema).load(path).count()


def _reading_counts(spec: TableSpec) -> list[Column]:
    """How many values of each column, and how many lines, did not read as declared."""
    bad = F.coalesce(F.map_keys(RESCUED), F.array().cast("array<string>"))
    return [F.count_if(F.array_contains(bad, c)).alias(f"bad_{c}") for c in spec.schema.fieldNames()] + [
        F.count_if(F.col(LINE).isNotNull() & F.col(RESCUED).isNull()).alias("broken"),
        F.count(LINE).alias("rescued"),
    ]


def _log_reading(ledger: Ledger, table: str, seen: Row, run_id: str) -> None:
    ledger.log_cast_failures(table, _bad_counts(seen.asDict()), run_id)
    ledger.log_broken_lines(table, seen["broken"], run_id)


def _keep_rescued(lake: Lake, table: str, run_id: str, given: DataFrame, seen: Row) -> None:
    """Store what came for the rows of ``given`` that did not read as declared; a load that reads the
    same lines again stores them again, under its own run."""
    if seen["rescued"]:
        _write_run(lake, given.where(F.col(LINE).isNotNull()), f"{table}{RESCUES}", run_id, ())


def rescued(lake: Lake, table: str) -> DataFrame:
    """What did not read as declared: per value its run, line, column and raw value, and per line with
    too many or too few fields and no such value, one row without a column. The bronze rows are
    stored like all others, with nulls for such values; the declared columns tell which they are."""
    kept = lake.table(LAYER, f"{table}{RESCUES}")
    return kept.select(
        F.col(RUN).alias("run_id"),
        *SPECS[table].schema.fieldNames(),
        F.col(LINE).alias("line"),
        F.explode_outer(RESCUED).alias("column", "raw_value"),
    )


def rejects(lake: Lake, table: str) -> DataFrame:
    """Rows that incremental loads left out, and why."""
    return lake.table(LAYER, f"{table}{REJECTS}").select(*SPECS[table].schema.fieldNames(), "reason")


def bronze_table(lake: Lake, table: str) -> DataFrame:
    """A loaded bronze table without the load partition column."""
    return lake.table(LAYER, table).select(*SPECS[table].schema.fieldNames())


class _logged:
    """Write the run-log row of a load that did not finish, and let the error through."""

    def __init__(self, ledger: Ledger, run_id: str, table: str, source: str):
        self.ledger, self.run_id, self.table, self.source = ledger, run_id, table, source

    def __enter__(self):
        return self

    def __exit__(self, kind, error, trace):
        if error is not None:
            status = DRIFTED if isinstance(error, SchemaDrift) else FAILED
            self.ledger.log_run(self.run_id, self.table, self.source, 0, status, str(error))
        return False
