"""A keyed stream: each key once, late rows kept apart, and the same result after any crash.

Two queries run one inside the other. The first cuts every batch of new files at the watermark, which
is the latest event time of all earlier batches less the delay: rows not after it are late and are kept
in a table of their own, the others go on. The second keeps the keys of the last ``delay`` days in its
state store and lets a key pass once; as late rows never reach it, it drops nothing but repeats, and
its state is bounded by the rows of the delay.

Every batch writes folders of its own number, so a batch that is run again replaces its rows and adds
none. A batch's mark is written after its rows; a batch that has one is not cut again, as the second
query may be in the middle of the files it made.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

REASON = "reason"
_CLOCK = "_event_clock"


@dataclass(frozen=True)
class KeyedStream:
    """Rows of ``schema`` under ``base``, told apart by ``key``, with their time in ``event``."""

    spark: SparkSession
    base: str
    schema: T.StructType
    key: tuple[str, ...]
    event: str
    delay_days: int

    def _folder(self, kind: str, batch: int | str = "*") -> str:
        return f"{self.base}/{kind}/{batch if isinstance(batch, str) else f'batch-{batch:010d}'}"

    def _read(self, kind: str, schema: T.StructType | str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self._folder(kind))

    def _start(self) -> KeyedStream:
        """Empty tables, where there are none yet."""
        late = T.StructType([*self.schema, T.StructField(REASON, T.StringType())])
        for kind, schema in (("rows", self.schema), ("late", late), ("passed", self.schema), ("marks", self._mark_schema)):
            self.spark.createDataFrame([], schema).write.mode("ignore").parquet(self._folder(kind, "start"))
        return self

    @property
    def _mark_schema(self) -> T.StructType:
        return T.StructType([T.StructField("batch", T.LongType()), T.StructField("seen", self.schema[self.event].dataType)])

    def rows(self) -> DataFrame:
        """The stored rows, one per key."""
        return self._read("rows", self.schema)

    def late(self) -> DataFrame:
        """Rows that came at or behind the watermark (``late``) or without an event time (``undated``)."""
        return self._read("late", T.StructType([*self.schema, T.StructField(REASON, T.StringType())]))

    def marks(self) -> DataFrame:
        """Per batch the latest event time of it and of all before it."""
        return self._read("marks", self._mark_schema)

    def take(self, stream: DataFrame) -> StreamingQuery:
        """Process everything that arrived since the last run, batch by batch, then stop. Returns the
        query that holds the state, of the last batch, for its figures."""
        self._start()
        last: list[StreamingQuery] = []

        def cut(batch: DataFrame, number: int) -> None:
            marks = {row["batch"]: row["seen"] for row in self.marks().where(F.col("batch") <= number).collect()}
            if number not in marks:
                self._cut(batch, number, max((t for t in marks.values() if t is not None), default=None))
            last[:] = [self._pass_keys()]

        query = (
            stream.writeStream.foreachBatch(cut)
            .option("checkpointLocation", f"{self.base}/checkpoints/cut")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return last[0] if last else self._pass_keys()

    def _cut(self, batch: DataFrame, number: int, seen) -> None:
        event = F.col(self.event)
        behind = F.lit(False) if seen is None else event <= F.lit(seen - timedelta(days=self.delay_days))
        reason = F.when(event.isNull(), "undated").when(behind, "late")
        rows = batch.withColumn(REASON, reason).persist()
        rows.where(F.col(REASON).isNotNull()).write.mode("overwrite").parquet(self._folder("late", number))
        passed = rows.where(F.col(REASON).isNull()).drop(REASON)
        passed.write.mode("overwrite").parquet(self._folder("passed", number))
        latest = passed.agg(F.max(event)).first()[0]
        known = [t for t in (seen, latest) if t is not None]
        mark = self.spark.createDataFrame([(number, max(known, default=None))], self._mark_schema)
        mark.coalesce(1).write.mode("overwrite").parquet(self._folder("marks", number))
        rows.unpersist()

    def _pass_keys(self) -> StreamingQuery:
        """Let the keys of new rows pass once. All new files are one batch, so that the watermark, which
        moves between batches, is never ahead of the one that the rows were cut at."""
        fresh = self.spark.readStream.schema(self.schema).parquet(self._folder("passed"))
        # the watermark needs an instant; event times are clock times, read in one zone
        timed = fresh.withColumn(_CLOCK, F.col(self.event).cast("timestamp"))
        once = timed.withWatermark(_CLOCK, f"{self.delay_days} days").dropDuplicatesWithinWatermark(list(self.key))

        def store(batch: DataFrame, number: int) -> None:
            batch.drop(_CLOCK).write.mode("overwrite").parquet(self._folder("rows", number))

        query = (
            once.writeStream.foreachBatch(store)
            .option("checkpointLocation", f"{self.base}/checkpoints/keys")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return query
