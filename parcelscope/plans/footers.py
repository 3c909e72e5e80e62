"""Bronze checks from Parquet footers: counts and nulls without reading a row.

Counts of rows and of values stand in every file's footer, and so do the bounds of whole numbers,
doubles and dates. The V2 Parquet source answers such aggregates from there. Bounds of texts and
clock times, distinct counts, and nulls of one of several key columns are not to be had from footers;
only their columns are scanned, and only where asked for.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelscope.operators.checks import stacked
from parcelscope.operators.joins import totals_side_by_side
from parcelscope.plans.quality import Expected, bronze_checks, bronze_totals
from parcelscope.schemas import SPECS

# What the V2 source is told; in a session of its own, as readers elsewhere keep theirs.
SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
# Types whose bounds footers hold for sure.
BOUNDED = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType)


def footer_frame(spark: SparkSession, path: str, schema: T.StructType, ranges: tuple[str, ...] = ()) -> DataFrame:
    """One row from the footers under ``path``: ``n`` rows, ``nulls_<column>`` of every column, and
    ``min_<column>`` and ``max_<column>`` of the ``ranges``.

    Planned in a session of its own; see ``footer_totals``.
    """
    unbounded = [c for c in ranges if not isinstance(schema[c].dataType, BOUNDED)]
    if unbounded:
        raise ValueError(f"footers have no bounds of {unbounded}")
    own = spark.newSession()
    for key, value in SETTINGS.items():
        own.conf.set(key, value)
    files = own.read.schema(schema).parquet(path)
    values = [F.count(f.name).alias(f"_{f.name}") for f in schema.fields]
    bounds = [of(c).alias(f"{name}_{c}") for c in ranges for name, of in (("min", F.min), ("max", F.max))]
    counted = files.agg(F.count(F.lit(1)).alias("n"), *values, *bounds)
    nulls = [(F.col("n") - F.col(f"_{f.name}")).alias(f"nulls_{f.name}") for f in schema.fields]
    return counted.select("n", *nulls, *[f"{name}_{c}" for c in ranges for name in ("min", "max")])


def footer_totals(spark: SparkSession, path: str, schema: T.StructType, ranges: tuple[str, ...] = ()) -> DataFrame:
    """``footer_frame`` as a row of the caller's session; one row goes over the driver."""
    found = footer_frame(spark, path, schema, ranges)
    return spark.createDataFrame([tuple(_row(found).values())], found.schema)


def _row(frame: DataFrame) -> dict:
    """The one row of a ``footer_frame``. Files without rows have no counts to add up: where all are
    such, the source gives null for a count."""
    row = frame.first().asDict()
    return {name: value or 0 if name == "n" or name.startswith("nulls_") else value for name, value in row.items()}


def suite_from_footers(
    spark: SparkSession, paths: Mapping[str, str], expected: Mapping[str, Expected], tolerance: float = 0.05
) -> DataFrame:
    """The rows of ``bronze_suite`` for tables stored as Parquet under ``paths``."""
    return stacked([_table(spark, t, path, expected.get(t), tolerance) for t, path in paths.items()])


def _table(spark: SparkSession, name: str, path: str, expected: Expected, tolerance: float) -> DataFrame:
    spec, wanted = SPECS[name], bronze_totals(name)
    keys = T.StructType([spec.schema[c] for c in spec.key])
    known = _row(footer_frame(spark, path, keys))
    nulls = [known[f"nulls_{c}"] for c in spec.key]
    told = {"n": known["n"]}
    if len(nulls) == 1 or not any(nulls):
        told["null_keys"] = sum(nulls)  # else rows with several nulls would count more than once
    scanned = [column for total, column in wanted.items() if total not in told]
    schema = T.StructType([T.StructField(total, T.LongType()) for total in told])
    totals = spark.createDataFrame([tuple(told.values())], schema)
    if scanned:
        totals = totals_side_by_side(totals, spark.read.schema(spec.schema).parquet(path).agg(*scanned))
    return bronze_checks(name, totals, expected, tolerance)
