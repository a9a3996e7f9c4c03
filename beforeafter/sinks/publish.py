"""Publish several tables at once, or none of them."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COMMIT = "run string, committed_at timestamp, name string, path string, n_rows long, columns string"


def in_file_order(df: DataFrame, keys: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Ranges of keys across files, sorted inside each: no global sort, no single task.

    Range bounds come from a sample of all keys, so list enough of them to split a hot one.
    """
    return df.repartitionByRange(*[F.col(k) for k in keys]).sortWithinPartitions(*within, *keys)


def write_sorted(
    df: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Parquet in key order, in folders by ``partition_by``."""
    in_file_order(df, keys, partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)


class PublishFailed(RuntimeError):
    pass


class Layout(NamedTuple):
    """How a published table's files lie: folders by some columns, and an order inside."""

    partition_by: Sequence[str] = ()
    sort_by: Sequence[str] = ()


def publish(
    spark: SparkSession,
    root: str,
    tables: Mapping[str, DataFrame],
    required: Sequence[str] = (),
    layouts: Mapping[str, Layout] | None = None,
) -> DataFrame:
    """Write every table into a new run folder, check it, then commit the run.

    A run is live once its rows are in the ``commits`` table, which is only ever
    appended to, by one file that appears whole or not at all; readers take the
    newest run there. Anything that fails before leaves the prior run live. Rows are
    counted while they are written, and compared with what the files hold.
    ``required`` names tables that must not be empty, ``layouts`` the tables that are
    written in folders or in order.
    """
    run = uuid.uuid4().hex
    done = []
    for name, df in tables.items():
        path = f"{root}/runs/{run}/{name}"
        seen = Observation(f"{name}-{run}")
        layout = (layouts or {}).get(name, Layout())
        laid = in_file_order(df, layout.sort_by, layout.partition_by) if layout.sort_by else df
        # Watched behind the shuffle: dealing by range reads its input twice.
        laid.observe(seen, F.count(F.lit(1)).alias("n")).write.partitionBy(*layout.partition_by).parquet(path)
        n_rows = seen.get["n"]
        back = spark.read.parquet(path)
        stored = [(f.name, f.dataType) for f in back.schema if f.name not in layout.partition_by]
        if stored != [(f.name, f.dataType) for f in df.schema if f.name not in layout.partition_by]:
            raise PublishFailed(f"{name}: files have another schema than the table")
        if back.count() != n_rows:
            raise PublishFailed(f"{name}: files do not hold the {n_rows} rows written")
        if name in required and not n_rows:
            raise PublishFailed(f"{name}: no rows")
        done.append((run, name, path, n_rows, df.schema.simpleString()))
    commit(spark, root, done)
    return live_run(spark, root)


def commit(spark: SparkSession, root: str, done: Sequence[tuple[str, str, str, int, str]]) -> None:
    """Make a run live: one file of (run, name, path, n_rows, columns) that appears whole."""
    rows = spark.createDataFrame(list(done), "run string, name string, path string, n_rows long, columns string")
    rows = rows.withColumn("committed_at", F.current_timestamp()).select(
        "run", "committed_at", "name", "path", "n_rows", "columns"
    )
    rows.coalesce(1).write.mode("append").parquet(f"{root}/commits")


def live_run(spark: SparkSession, root: str) -> DataFrame:
    """The manifest of the newest committed run; no rows if there is none."""
    try:
        commits = spark.read.schema(_COMMIT).parquet(f"{root}/commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _COMMIT)
    newest = F.struct("committed_at", "run")
    return commits.filter(newest == commits.agg(F.max(newest)).scalar())


def published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the live run."""
    row = live_run(spark, root).filter(F.col("name") == name).first()
    if row is None:
        raise LookupError(f"no published table {name!r} under {root}")
    schema = T.StructType.fromDDL(row["columns"])
    return spark.read.schema(schema).parquet(row["path"]).select(*schema.names)
