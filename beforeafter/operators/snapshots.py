"""Point-in-time values of each entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beforeafter.operators.windows import rows_at
from beforeafter.schema import EVENT_KEYS
from beforeafter.sources.panel import resolve_duplicates
from beforeafter.staging import stage_side


def snapshot_latest(
    panel: DataFrame,
    latest: str | int = "global",
    duplicates: str = "error",
    order: Sequence[str] = (),
) -> DataFrame:
    """``entity, indicator, value`` at the latest time.

    ``global`` is the greatest time over all sources, ``per_source`` each source's
    own, a number a fixed time. ``duplicates`` settles a code that two sources share.
    """
    if latest == "per_source":
        last = stage_side(panel.groupBy("source").agg(F.max("time").alias("time")), "last-times")
        at = panel.join(last, ["source", "time"], "left_semi")
    elif latest == "global":
        at = panel.filter(F.col("time") == panel.agg(F.max("time")).scalar())
    else:
        at = panel.filter(F.col("time") == F.lit(int(latest)))
    keys = ["entity", "indicator"]
    return resolve_duplicates(at, duplicates, keys, order).select(*keys, "value")


def snapshot_at_event(
    panel: DataFrame,
    events: DataFrame,
    duplicates: str = "error",
    order: Sequence[str] = (),
) -> DataFrame:
    """``entity, event_at, indicator, value`` at each event's own time; an entity
    with two events has two snapshots."""
    own = events.select(*EVENT_KEYS).dropDuplicates(list(EVENT_KEYS)).withColumn("time", F.col("event_at"))
    at = rows_at(panel, own)
    keys = [*EVENT_KEYS, "indicator"]
    return resolve_duplicates(at, duplicates, keys, order).select(*keys, "value")
