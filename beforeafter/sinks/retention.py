"""Going back to an earlier published run, and clearing those that nobody needs."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beforeafter.sinks.publish import _COMMIT, commit, live_run

_LEASE = "run string, until long"


def _commits(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(_COMMIT).parquet(f"{root}/commits")


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _exists(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return fs.exists(at)


def runs(spark: SparkSession, root: str) -> DataFrame:
    """Every run ever committed under ``root``: ``run``, ``committed_at`` (its newest
    commit), ``tables`` and ``live``; none before the first."""
    live = live_run(spark, root).select("run").distinct().withColumn("live", F.lit(True))
    if not _exists(spark, f"{root}/commits"):
        return spark.createDataFrame([], "run string, committed_at timestamp, tables long, live boolean")
    listed = _commits(spark, root).groupBy("run").agg(F.max("committed_at").alias("committed_at"), F.count_distinct("name").alias("tables"))
    # One row a run on both sides.
    return listed.join(live, "run", "left").select("run", "committed_at", "tables", F.coalesce("live", F.lit(False)).alias("live"))


def rollback(spark: SparkSession, root: str, run: str | None = None) -> DataFrame:
    """Makes an earlier run live again, by default the one before the live one, and
    returns its manifest.

    It is committed anew, by one file like any other, so readers see the run before or
    the one after and a later ``rollback`` can undo this one. Raises if the run was never
    committed or has been cleared.
    """
    if run is None:
        earlier = runs(spark, root).filter(~F.col("live")).orderBy(F.desc("committed_at"), F.desc("run")).first()
        if earlier is None:
            raise LookupError(f"no run before the live one under {root}")
        run = earlier["run"]
    # One row a table of the run.
    rows = _commits(spark, root).filter(F.col("run") == run).groupBy("name").agg(F.max_by(F.struct("path", "n_rows", "columns"), "committed_at").alias("m")).collect()
    if not rows:
        raise LookupError(f"run {run} was never committed under {root}")
    gone = [r["name"] for r in rows if not _exists(spark, r["m"]["path"])]
    if gone:
        raise LookupError(f"run {run} has been cleared: no files of {', '.join(sorted(gone))}")
    commit(spark, root, [(run, r["name"], r["m"]["path"], r["m"]["n_rows"], r["m"]["columns"]) for r in rows])
    return live_run(spark, root)


@contextmanager
def reading(spark: SparkSession, root: str, seconds: int = 3_600) -> Iterator[DataFrame]:
    """The live run's manifest, kept from being cleared until the block ends, or for
    ``seconds`` if its process dies.

    The lease is written before the manifest is read again: if the run was cleared in
    between, the next live one is taken.
    """
    while True:
        found = live_run(spark, root).select("run").first()
        if found is None:
            raise LookupError(f"nothing published under {root}")
        lease = f"{root}/leases/{uuid.uuid4().hex}"
        held = spark.createDataFrame([(found["run"], int(time.time()) + seconds)], _LEASE)
        held.coalesce(1).write.parquet(lease)
        manifest = live_run(spark, root)
        if manifest.filter(F.col("run") != found["run"]).isEmpty():
            break
        _delete(spark, lease)
    try:
        yield manifest
    finally:
        _delete(spark, lease)


def _delete(spark: SparkSession, path: str) -> None:
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def clear(spark: SparkSession, root: str, keep: int = 2) -> DataFrame:
    """Deletes the files of committed runs, but for the live one, the ``keep`` newest (the
    live one counts) and those that a reader holds; returns one row per run cleared.

    Runs that are being written have no commit yet and are left alone; the log of
    commits stays whole. Leases that have run out are deleted too. One ``clear`` at a
    time, and no ``rollback`` beside it.
    """
    if keep < 1:
        raise ValueError("the live run is always kept: keep at least 1")
    # One row a run, listed before the leases: a reader that comes later finds another run
    # live, and takes that.
    listed = runs(spark, root).orderBy(F.desc("live"), F.desc("committed_at"), F.desc("run")).collect()
    held = set()
    if _exists(spark, f"{root}/leases"):
        leases = spark.read.schema(_LEASE).option("recursiveFileLookup", True).parquet(f"{root}/leases")
        # One row an open reader.
        for r in leases.select("run", "until", F.col("_metadata.file_path").alias("file")).collect():
            if r["until"] >= time.time():
                held.add(r["run"])
            else:
                _delete(spark, r["file"].rsplit("/", 1)[0])
    cleared = []
    for r in listed[keep:]:
        path = f"{root}/runs/{r['run']}"
        if not r["live"] and r["run"] not in held and _exists(spark, path):
            _delete(spark, path)
            cleared.append((r["run"], r["tables"]))
    return spark.createDataFrame(cleared, "run string, tables long")
