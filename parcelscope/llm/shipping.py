"""Makes this package importable in Python workers of sessions whose machines do not have it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Hand the package's source to Spark's own file distribution, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        archive = Path(tempfile.mkdtemp(prefix="parcelscope-")) / "parcelscope.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for source in sorted(_PACKAGE.rglob("*.py")):
                out.write(source, source.relative_to(_PACKAGE.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)
    return spark
