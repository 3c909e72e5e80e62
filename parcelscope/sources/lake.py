"""Lake tables: path scans, catalog scans, and the write modes of the three layers."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


VERSION = "version_"


@dataclass(frozen=True)
class Lake:
    """Tables under ``root``, one folder per layer, registered as ``<prefix><layer>.<table>``.

    ``fmt`` is any file format the session knows (Parquet by default; a table format with its own
    commit log works through the same calls).
    """

    spark: SparkSession
    root: str
    fmt: str = "parquet"
    prefix: str = ""

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def name(self, layer: str, table: str) -> str:
        return f"{self.database(layer)}.{table}"

    def database(self, layer: str) -> str:
        """Create the layer's database inside the lake and return its name."""
        database = f"{self.prefix}{layer}"
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.root.rstrip('/')}/{layer}'"
        )
        return database

    # scans

    def load(self, layer: str, table: str) -> DataFrame:
        return self.spark.read.format(self.fmt).load(self.path(layer, table))

    def table(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    # sinks

    def append(self, df: DataFrame, layer: str, table: str, partition_by: tuple[str, ...] = ()) -> None:
        df.write.format(self.fmt).mode("append").partitionBy(*partition_by).save(
            self.path(layer, table)
        )

    def overwrite(
        self, df: DataFrame, layer: str, table: str, partition_by: tuple[str, ...] = ()
    ) -> None:
        """Replace the table's files in place."""
        df.write.format(self.fmt).mode("overwrite").partitionBy(*partition_by).save(
            self.path(layer, table)
        )

    def refresh(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        partition_by: tuple[str, ...] = (),
        bucket_by: tuple[int, str] | None = None,
    ) -> DataFrame:
        """Full refresh: write a new version as a table of its own, then point the view ``table`` at it.

        The view is replaced in one step after the version is complete, so readers see the old rows
        or the new rows, also if the write fails, whatever the layout or schema; ``df`` may read
        the table it replaces. ``bucket_by`` lays the files out by one key, so later joins and
        aggregates on it need no shuffle; leave it off for keys that may be hot.
        """
        name, tag = self.name(layer, table), uuid.uuid4().hex
        version = f"{self.database(layer)}.{table}_{VERSION}{tag}"
        writer = df.write.format(self.fmt).mode("error").partitionBy(*partition_by)
        if bucket_by is not None:
            count, column = bucket_by
            writer = writer.bucketBy(count, column).sortBy(column)
        writer.option("path", f"{self.path(layer, table)}/{VERSION}{tag}").saveAsTable(version)
        if self.exists(layer, table) and self.spark.catalog.getTable(name).tableType != "VIEW":
            # registered by another kind of load: its files stay where they are
            self.spark.sql(f"ALTER TABLE {name} RENAME TO {version}_before")
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
        return self.spark.table(name)

    def drop_old_versions(self, layer: str, table: str) -> int:
        """Delete the versions that a refreshed table's view no longer points at. Returns how many.

        Not part of ``refresh``: jobs that started before it may still be reading them.
        """
        text = (
            self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(layer, table)}")
            .where("col_name = 'View Text'")
            .first()["data_type"]
        )
        current = text.rsplit(f"{table}_", 1)[-1]
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(layer, table))
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        dropped = 0
        for status in files.listStatus(folder):
            name = status.getPath().getName()
            if current.startswith(VERSION) and name.startswith(VERSION) and name != current:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.database(layer)}.{table}_{name}")
                dropped += bool(files.delete(status.getPath(), True))
        return dropped

    def save_managed(self, df: DataFrame, layer: str, table: str) -> DataFrame:
        name = self.name(layer, table)
        df.write.format(self.fmt).mode("overwrite").saveAsTable(name)
        return self.spark.table(name)

    def register(self, layer: str, table: str, path: str | None = None) -> None:
        """Register existing files as an external table; picks up new partition folders."""
        name = self.name(layer, table)
        location = path or self.path(layer, table)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} USING {self.fmt} LOCATION '{location}'"
        )
        if any(c.isPartition for c in self.spark.catalog.listColumns(name)):
            self.spark.catalog.recoverPartitions(name)
