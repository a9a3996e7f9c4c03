"""Event windows: a band of time offsets around each event, baselines and change."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beforeafter.functions import percent_change
from beforeafter.schema import EVENT_KEYS, FACT_COLUMNS, SERIES_KEYS
from beforeafter.staging import BROADCAST_BYTES, row_bytes, stage, stage_side


def event_skeleton(events: DataFrame, first: int, last: int) -> DataFrame:
    """Every event with every offset in ``first..last`` and the time it falls on."""
    return (
        events.select(*EVENT_KEYS)
        .dropDuplicates(list(EVENT_KEYS))
        .withColumn("offset", F.explode(F.sequence(F.lit(first), F.lit(last))))
        .withColumn("time", F.col("event_at") + F.col("offset"))
    )


def rows_at(panel: DataFrame, moments: DataFrame) -> DataFrame:
    """Panel rows at the listed (entity, time) moments, with the moments' columns.

    One pass over the moments finds their size, which decides on a broadcast, and
    their time span, which prunes the panel scan. Above the broadcast limit both
    sides shuffle on (entity, time): a hot entity is spread over its times, and
    Spark splits what is still hot.
    """
    found = moments.agg(
        row_bytes(moments).alias("bytes"), F.min("time").alias("first"), F.max("time").alias("last")
    ).first()
    spanned = panel.filter(F.col("time").between(F.lit(found["first"]), F.lit(found["last"])))
    side = F.broadcast(moments) if (found["bytes"] or 0) <= BROADCAST_BYTES else moments
    return spanned.join(side, ["entity", "time"])


def event_window(
    panel: DataFrame,
    events: DataFrame,
    first: int = -6,
    last: int = 6,
    how: str = "inner",
) -> DataFrame:
    """Panel rows at each offset of each event.

    ``inner`` keeps observed times only; ``left`` fills every series seen in a
    window up to all its offsets, with NULL values.
    """
    skeleton = event_skeleton(events, first, last)
    observed = rows_at(panel, skeleton).select(
        *EVENT_KEYS, "offset", "time", "indicator", "source", "value"
    )
    if how == "inner":
        return observed
    if how != "left":
        raise ValueError(f"how must be inner or left, not {how!r}")
    observed = stage(observed, "window")  # read twice below
    unobserved = (
        observed.groupBy(*SERIES_KEYS)
        .agg(F.collect_set("offset").alias("seen"))  # at most last - first + 1 offsets
        .withColumn("offset", F.explode(F.array_except(F.sequence(F.lit(first), F.lit(last)), "seen")))
        .withColumn("time", F.col("event_at") + F.col("offset"))
        .withColumn("value", F.lit(None).cast("double"))
        .drop("seen")
    )
    return observed.unionByName(unobserved)


def add_baseline(
    fact: DataFrame,
    offsets: Iterable[int] = (-3, -2, -1),
    keys: Sequence[str] = SERIES_KEYS,
    unique_times: bool = False,
) -> DataFrame:
    """Mean value over the chosen offsets of each series, on every row of the series.

    ``unique_times=True`` says that a series has one row per time, as after
    ``resolve_duplicates``: a series is then no longer than the window, and one
    shuffle with a window average does. Otherwise a series may hold any number of
    rows, so the mean is aggregated before the shuffle and joined back, by
    broadcast if the means are few, else with hot partitions split by Spark.
    ``fact`` is then read twice, so stage it. ``keys`` without ``source`` averages
    over sources.
    """
    base = F.when(F.col("offset").isin(list(offsets)), F.col("value"))
    if unique_times:
        return fact.withColumn("baseline_value", F.avg(base).over(Window.partitionBy(*keys)))
    means = fact.filter(F.col("offset").isin(list(offsets))).groupBy(*keys).agg(F.avg("value").alias("baseline_value"))
    return fact.join(stage_side(means, "baselines"), list(keys), "left")


def add_change(fact: DataFrame) -> DataFrame:
    changed = fact.withColumn("pct_change", percent_change(F.col("value"), F.col("baseline_value")))
    return changed.select(*FACT_COLUMNS)


def event_window_change(
    panel: DataFrame,
    events: DataFrame,
    first: int = -6,
    last: int = 6,
    baseline_offsets: Iterable[int] = (-3, -2, -1),
    baseline_keys: Sequence[str] = SERIES_KEYS,
    unique_times: bool = False,
    how: str = "inner",
) -> DataFrame:
    """The event-window fact: value, baseline and percent change per event, series and offset."""
    fact = event_window(panel, events, first, last, how)
    if not unique_times:
        fact = stage(fact, "window")
    return add_change(add_baseline(fact, baseline_offsets, baseline_keys, unique_times))


def sample_series(
    fact: DataFrame,
    entity: str | None = None,
    event_at: int | None = None,
    indicator: str | None = None,
) -> DataFrame:
    """One event's series for one indicator in time order.

    What is not asked for is the smallest key, so the sample is always the same.
    ``fact`` is read twice.
    """
    if entity is not None:
        fact = fact.filter(F.col("entity") == entity)
    if event_at is not None:
        fact = fact.filter(F.col("event_at") == event_at)
    if indicator is not None:
        fact = fact.filter(F.col("indicator") == indicator)
    key = F.struct(*EVENT_KEYS, "indicator")
    return fact.filter(key == fact.agg(F.min(key)).scalar()).orderBy("source", "offset")


def pre_event_means(panel: DataFrame, events: DataFrame, before: int = 6) -> DataFrame:
    """Mean over the ``before`` times ahead of each event, with the number of values.

    Sources that share an indicator code are averaged together.
    """
    skeleton = event_skeleton(events, -before, -1).select(*EVENT_KEYS, "time")
    return rows_at(panel, skeleton).groupBy(*EVENT_KEYS, "indicator").agg(
        F.avg("value").alias("avg_value"), F.count("value").alias("n_values")
    )
