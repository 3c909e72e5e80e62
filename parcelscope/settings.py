"""Session settings, shuffle sizing and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. The skew settings let adaptive execution split a hot join
# key even when a later operator would have reused the join's partitioning.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # hashed keys are hexadecimal text, which only an entropy coder makes smaller
    "spark.sql.parquet.compression.codec": "zstd",
}
# Fixed when the session starts. Recording a Python call site for every column expression would
# dominate plan building.
STATIC = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

PARTITION_BYTES = 192 * 1024 * 1024


def shuffle_partitions(input_bytes: int, cores: int, partition_bytes: int = PARTITION_BYTES) -> int:
    """Initial shuffle partitions so that one partition fits an executor core's memory share.

    Adaptive execution only coalesces downwards, so the starting number is sized from the input and
    rounded up to whole waves of ``cores``. 100 TB over 4,000 cores gives 548,000 partitions of
    about 192 MB.
    """
    needed = max(1, -(-input_bytes // partition_bytes))
    return -(-needed // cores) * cores


def configure(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    if input_bytes is not None:
        cores = spark.sparkContext.defaultParallelism
        spark.conf.set("spark.sql.shuffle.partitions", shuffle_partitions(input_bytes, cores))
    return spark


def build_session(
    app: str, master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**RUNTIME, **STATIC, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# The folders of the runs that are open, the innermost last.
_RUNS: ContextVar[tuple[str, ...]] = ContextVar("runs", default=())


@contextmanager
def scratch_run(spark: SparkSession, label: str) -> Iterator[None]:
    """Scratch folders made inside lie in one folder, which is removed at the end.

    For work whose result is stored elsewhere by then. A run that dies with its driver leaves its
    folder; nobody else uses it.
    """
    folder = scratch_dir(spark, label)
    token = _RUNS.set((*_RUNS.get(), folder))
    try:
        yield
    finally:
        _RUNS.reset(token)
        remove(spark, folder)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the shared file system, if it is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    Where ``spark.checkpoint.dir`` is unset, a session in one process (unit tests) gets a local
    folder; one with executors elsewhere is refused, as their local folders are not shared.
    """
    if _RUNS.get():
        return f"{_RUNS.get()[-1]}/{label}-{uuid.uuid4().hex}"
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local") or "cluster" in spark.conf.get("spark.master"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="parcelscope-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/parcelscope/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Used where one result feeds several aggregates: it is computed once, its lineage ends in files
    that outlive any executor, and later reads are column-pruned scans.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
