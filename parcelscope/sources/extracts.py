"""CSV extracts: string scan, schema-drift gate, cast by name."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelscope.schemas import TableSpec


# Columns of ``parsed`` beside the declared ones: the line as it came, and the raw values that did
# not parse, by column. Both are null for a line that reads as declared.
LINE, RESCUED = "_line", "_rescued"
_BROKEN = "_broken"


class SchemaDrift(Exception):
    """The extract's columns differ from the expected ones."""


@dataclass(frozen=True)
class Drift:
    unexpected: tuple[str, ...]
    missing: tuple[str, ...]

    def __bool__(self) -> bool:
        return bool(self.unexpected or self.missing)

    @property
    def message(self) -> str:
        return (
            f"header differs: undeclared columns {list(self.unexpected)}, absent columns {list(self.missing)}"
        )


def read_extract(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """Read headed CSV as strings under the file's own column names.

    No schema is imposed: one given here would be applied by position and would hide drift.
    ``enforceSchema=false`` makes a file whose header differs from the first file's fail the read
    instead of shifting its values. ``multi_line`` keeps quoted line breaks inside one record and
    costs file splitting, so such extracts should arrive as many files.
    """
    return _reader(spark, multi_line).csv(path)


def _reader(spark: SparkSession, multi_line: bool) -> DataFrameReader:
    return (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
    )


def read_lines(spark: SparkSession, path: str | list[str], spec: TableSpec) -> DataFrame:
    """The extract's columns as strings, past the drift gate, and the raw text of lines with more or
    fewer fields than the header.

    The header decides the schema, in the file's own order; a file with another header fails the read.
    """
    header = require_columns(read_extract(spark, path, spec.multi_line), spec).schema
    schema = T.StructType([*header.fields, T.StructField(_BROKEN, T.StringType())])
    return _reader(spark, spec.multi_line).option("columnNameOfCorruptRecord", _BROKEN).schema(schema).csv(path)


def parsed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns of ``read_lines`` rows, typed, with ``LINE`` and ``RESCUED``.

    Every line stays a row. The line of a row with the right number of fields is written anew from
    them, as the reader keeps the text of broken lines only.
    """
    raw = [F.col(f"`{name}`") for name in schema.fieldNames()]
    failed = {f.name: F.when(_failed(f), F.col(f"`{f.name}`")) for f in schema.fields if not _is_text(f)}
    values = F.lit(None).cast("map<string,string>")
    if failed:
        values = F.map_from_arrays(F.array(*map(F.lit, failed)), F.array(*failed.values()))
        values = F.map_filter(values, lambda _, value: value.isNotNull())
        values = F.when(F.coalesce(*failed.values()).isNotNull(), values)
    line = F.coalesce(F.col(_BROKEN), F.when(values.isNotNull(), F.to_csv(F.struct(*raw))))
    return lines.select(
        *[_cast(f).alias(f.name) for f in schema.fields], line.alias(LINE), values.alias(RESCUED)
    )


def find_drift(columns: list[str], expected: T.StructType) -> Drift:
    names = expected.fieldNames()
    return Drift(
        unexpected=tuple(c for c in columns if c not in names),
        missing=tuple(c for c in names if c not in columns),
    )


def require_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    drift = find_drift(df.columns, spec.schema)
    if drift:
        raise SchemaDrift(drift.message)
    return df


def _cast(field: T.StructField) -> Column:
    raw = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return raw
    if isinstance(field.dataType, T.LongType):
        # '12.0' is a whole number written by a tool that thinks in doubles
        return F.coalesce(raw.try_cast("long"), F.bround(raw.try_cast("double")).try_cast("long"))
    return F.trim(raw).try_cast(field.dataType)


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the expected columns by name and cast them; what does not parse becomes null."""
    return df.select(*[_cast(f).alias(f.name) for f in schema.fields])


def _is_text(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.StringType)


def _failed(field: T.StructField) -> Column:
    """A value is there but does not parse."""
    return F.col(f"`{field.name}`").isNotNull() & _cast(field).isNull()
