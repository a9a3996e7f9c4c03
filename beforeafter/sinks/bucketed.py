"""A panel stored so that event joins need not move it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beforeafter.operators.windows import event_skeleton
from beforeafter.schema import EVENT_KEYS

#: What a panel is dealt and sorted by: a hot entity is spread over its times.
KEYS = ("entity", "time")


def write_bucketed(panel: DataFrame, table: str, buckets: int, path: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Writes the panel once as ``table`` under ``path``: dealt by ``keys`` into ``buckets``
    files, each sorted. Replaces a table of that name. ``path`` is a shared folder; take
    buckets of some hundred megabytes, and a few times the cores at least.
    """
    dealt = panel.repartition(buckets, *[F.col(k) for k in keys])
    dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return panel.sparkSession.table(table)


def attach_bucketed(spark: SparkSession, table: str, schema: str, buckets: int, path: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """The table of an earlier session, made known to this one; ``schema`` as DDL."""
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE `{table}` ({schema}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(table)


def bucketed_window(panel: DataFrame, events: DataFrame, first: int = -6, last: int = 6) -> DataFrame:
    """``event_window`` on a panel of ``write_bucketed``, for events above the broadcast limit.

    The events and their offsets shuffle to the buckets by (entity, time); the panel is
    read where it lies, however often it is joined. The same rows come from any panel,
    with a shuffle.
    """
    moments = event_skeleton(events, first, last)
    joined = panel.join(moments.hint("merge"), list(KEYS))
    return joined.select(*EVENT_KEYS, "offset", "time", "indicator", "source", "value")
