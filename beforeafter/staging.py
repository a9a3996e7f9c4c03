"""Where intermediate tables go, and when a side is small enough to broadcast."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only if its measured size is below this many bytes.
BROADCAST_BYTES = 64 * 1024 * 1024

_local_dir: str | None = None

# Folders written by ``stage`` since each open ``scope`` began.
_scopes: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, seen by every executor.

    A local master may leave it unset and gets a temporary folder. Any other
    master has to name one: executors cannot read what another machine keeps on
    its own disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"spark.checkpoint.dir has to name a shared folder for master {master}")
    global _local_dir
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="beforeafter-")
    return _local_dir


def run_dir(spark: SparkSession) -> str:
    """Where this application's intermediate tables lie."""
    return f"{shared_dir(spark)}/beforeafter/{spark.sparkContext.applicationId}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    For frames that several later steps read: the work behind them is done once,
    lineage ends at files that outlive an executor, and later filters and column
    lists reach the scan. Files lie in one folder per application and stay until
    ``release``: lazy results may still read them.
    """
    spark = df.sparkSession
    path = f"{run_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if _scopes:
        _scopes[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete this application's intermediate tables. To be called once every
    result that reads them has been written or collected."""
    delete(spark, run_dir(spark))


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder, on whatever file system it lies."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, what ``stage`` wrote inside it. For work whose result has
    been written by then: lazy results from inside must not be read behind it."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            delete(spark, path)


def stage_side(df: DataFrame, label: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Stage a join side that is derived from much data; its size is measured
    while it is written, and a small one comes back hinted for broadcast."""
    seen = Observation()
    staged = stage(df.observe(seen, row_bytes(df).alias("bytes")), label)
    return F.broadcast(staged) if (seen.get["bytes"] or 0) <= limit else staged


def row_bytes(df: DataFrame) -> Column:
    """Sum of the row bytes of ``df``: 8 per number, 16 and its length per text."""
    size = F.lit(16).cast("long")
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.lit(16) + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
        else:
            size = size + F.lit(8)
    return F.sum(size)


def measured_bytes(df: DataFrame) -> int:
    """Row bytes of ``df``, counted by one aggregate pass (one row per task)."""
    return df.agg(row_bytes(df)).first()[0] or 0


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast if ``df`` measures at most ``limit`` bytes.

    Above the limit the frame comes back unhinted and Spark shuffles both sides,
    with adaptive skew splitting for hot keys. Nested columns are not measured,
    so frames that carry them must be bounded by other means. The pass runs the
    work behind ``df``: for sides derived from much data take ``stage_side``.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df
