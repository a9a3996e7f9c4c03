"""Bring landed tables into the long panel form."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beforeafter.functions import clean_number, quoted
from beforeafter.schema import PANEL_COLUMNS, PANEL_KEYS
from beforeafter.staging import broadcast_if_small


def observations(
    df: DataFrame,
    entity: str = "iso3",
    indicator: str = "indicator_code",
    time: str = "year",
    value: str = "value",
) -> DataFrame:
    """Pick and cast the four observation columns; NaN and infinities become NULL."""
    return df.select(
        quoted(entity).cast("string").alias("entity"),
        quoted(indicator).cast("string").alias("indicator"),
        quoted(time).try_cast("int").alias("time"),
        clean_number(quoted(value)).alias("value"),
    )


def tag_source(df: DataFrame, source: str) -> DataFrame:
    return df.withColumn("source", F.lit(source))


def unify(*panels: DataFrame) -> DataFrame:
    """Union by column name. Duplicate keys stay: see ``resolve_duplicates``."""
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), panels)
    return together.select(*PANEL_COLUMNS)


def resolve_duplicates(
    panel: DataFrame,
    policy: str = "error",
    keys: Sequence[str] = PANEL_KEYS,
    order: Sequence[str] = (),
) -> DataFrame:
    """One row per key. All policies aggregate before the shuffle, so any number
    of copies of one key is fine.

    ``error`` fails the query if a key repeats, ``mean`` averages, ``any`` takes
    the smallest value, ``prefer_source`` takes the source that comes first in
    ``order`` (sources outside it come last, by name). NULL values never win
    over numbers.
    """
    if policy == "error":
        value = F.when(
            F.count(F.lit(1)) > 1,
            F.raise_error(
                F.concat(F.lit("repeated key: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
            ).cast("double"),
        ).otherwise(F.max("value"))
        extra = [F.min("source").alias("source")] if "source" not in keys else []
        return panel.groupBy(*keys).agg(*extra, value.alias("value"))
    if policy == "mean":
        return panel.groupBy(*keys).agg(F.avg("value").alias("value"))
    if policy == "any":
        return panel.groupBy(*keys).agg(F.min("value").alias("value"))
    if policy == "prefer_source":
        rank = F.lit(len(order))
        for i, name in reversed(list(enumerate(order))):
            rank = F.when(F.col("source") == name, F.lit(i)).otherwise(rank)
        best = F.min(F.struct(F.col("value").isNull().alias("n"), rank.alias("r"), "source", "value"))
        picked = panel.groupBy(*keys).agg(best.alias("best"))
        extra = [F.col("best.source").alias("source")] if "source" not in keys else []
        return picked.select(*keys, *extra, F.col("best.value").alias("value"))
    raise ValueError(f"unknown policy {policy!r}")


def unpivot_times(
    wide: DataFrame,
    entity: str = "economy",
    indicator: str = "series",
    pattern: str = r"^(?:YR)?(-?\d+)$",
) -> DataFrame:
    """Wide blocks with one column per time → observations, valueless rows dropped.

    Time columns are those whose whole name matches ``pattern``; its group is the time.
    """
    times = [c for c in wide.columns if c not in (entity, indicator) and re.match(pattern, c)]
    if not times:
        raise ValueError("no time columns found")
    long = wide.select(
        quoted(entity).alias("entity"),
        quoted(indicator).alias("indicator"),
        *[clean_number(quoted(c)).alias(c) for c in times],
    ).unpivot(["entity", "indicator"], [quoted(c) for c in times], "time", "value")
    numbered = long.withColumn("time", F.regexp_extract("time", pattern, 1).try_cast("int"))
    return drop_valueless(numbered)


def drop_valueless(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["value"])


def between_times(panel: DataFrame, first: int, last: int) -> DataFrame:
    """Inclusive time range; reaches the Parquet scan as a pushed filter."""
    return panel.filter(F.col("time").between(first, last))


def three_capitals(code: Column) -> Column:
    """True for codes of exactly three capital letters."""
    return code.rlike(r"\A[A-Z]{3}\z")


def wanted_entities(catalogue: DataFrame, minimum: int | None = None) -> DataFrame:
    """Real entities of a catalogue with ``id, aggregate, region``.

    Kept if marked as no aggregate or if it has a region. With a ``minimum``, a filter
    that leaves fewer is judged wrong and all are kept; ``fallback`` tells on every row
    whether that happened.
    """
    real = F.coalesce(~F.col("aggregate"), F.lit(False)) | (F.coalesce("region", F.lit("")) != "")
    if minimum is None:
        return catalogue.filter(real).withColumn("fallback", F.lit(False))
    fallback = catalogue.agg(F.count_if(real).alias("n")).scalar() < minimum
    return catalogue.withColumn("fallback", fallback).filter(real | F.col("fallback"))


def only_entities(panel: DataFrame, entities: DataFrame, column: str = "id") -> DataFrame:
    """Panel rows of the listed entities."""
    ids = entities.select(F.col(column).alias("entity")).distinct()
    return panel.join(broadcast_if_small(ids), "entity", "left_semi")


def read_events(spark: SparkSession, path: str, entity: str = "iso3", event_at: str = "year") -> DataFrame:
    """One row per (entity, time) of a CSV with a header; see ``events_from``."""
    return events_from(read_events_text(spark, path, entity, event_at), entity, event_at)


def read_events_text(spark: SparkSession, path: str, entity: str = "iso3", event_at: str = "year") -> DataFrame:
    """All columns of an events CSV as text, found by the names in its header, in any
    order. Files whose headers differ, or without the two columns, are an error."""
    raw = spark.read.csv(path, header=True, enforceSchema=False)
    missing = [c for c in (entity, event_at) if c not in raw.columns]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {path}, only {', '.join(raw.columns)}")
    return raw


def _event_fault(entity: Column, event_at: Column) -> Column:
    return (
        F.when(entity.isNull(), "no entity")
        .when(event_at.isNull(), "no time")
        .when(event_at.try_cast("int").isNull(), "bad time")
    )


def events_from(df: DataFrame, entity: str, event_at: str) -> DataFrame:
    """Any table as events: two columns, cast and deduplicated, without the rows that
    ``event_rejects`` lists."""
    return (
        df.filter(_event_fault(quoted(entity), quoted(event_at)).isNull())
        .select(
            quoted(entity).cast("string").alias("entity"),
            quoted(event_at).try_cast("int").alias("event_at"),
        )
        .dropDuplicates(["entity", "event_at"])
    )


def event_rejects(df: DataFrame, entity: str, event_at: str) -> DataFrame:
    """The rows that are no events, with the reason in ``rejected``."""
    fault = _event_fault(quoted(entity), quoted(event_at))
    return df.filter(fault.isNotNull()).withColumn("rejected", fault)


def ingest_report(
    df: DataFrame, entity: str = "iso3", indicator: str = "indicator_code", time: str = "year", value: str = "value"
) -> DataFrame:
    """One row that accounts for every landed observation: rows, rows with a usable
    value, and the others by their first fault. ``observations`` keeps rows with faults
    and sets the faulty time or value to NULL; ``drop_valueless`` then drops them."""
    t, v = quoted(time), quoted(value)
    number = v.try_cast("double")
    fault = (
        F.when(quoted(entity).isNull() | quoted(indicator).isNull(), "no_key")
        .when(t.try_cast("int").isNull(), "bad_time")
        .when(v.isNull(), "no_value")
        .when(number.isNull(), "bad_value")
        .when(clean_number(v).isNull(), "not_finite")
    )
    faults = ("no_key", "bad_time", "no_value", "bad_value", "not_finite")
    return df.select(fault.alias("fault")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("fault").isNull()).alias("n_usable"),
        *[F.count_if(F.col("fault") == f).alias(f"n_{f}") for f in faults],
    )


def profile(panel: DataFrame, by: str | None = None, approximate: bool = False) -> DataFrame:
    """Rows, distinct indicators and entities, time span and valueless rows, in one pass."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    measures = [
        F.count(F.lit(1)).alias("n_rows"),
        distinct("indicator").alias("n_indicators"),
        distinct("entity").alias("n_entities"),
        F.min("time").alias("first_time"),
        F.max("time").alias("last_time"),
        F.count_if(F.col("value").isNull()).alias("n_valueless"),
    ]
    return panel.groupBy(by).agg(*measures) if by else panel.agg(*measures)
