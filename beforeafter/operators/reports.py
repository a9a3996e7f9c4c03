"""The queries behind the dashboard views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beforeafter.schema import EVENT_KEYS
from beforeafter.staging import broadcast_if_small


def score_by_region(scores: DataFrame, entities: DataFrame, regions: Sequence[str] | None = None) -> DataFrame:
    """Scores with name, region and income group, for all or the given regions."""
    # One row per entity on both sides, so the choice of join is Spark's.
    joined = scores.join(entities, "entity", "left")
    return joined.filter(F.col("region").isin(list(regions))) if regions is not None else joined


def top_ranked(scores: DataFrame, k: int, score: str = "readiness_score") -> DataFrame:
    """The ``k`` best rows with their rank; ties share a rank and come in name order."""
    best = scores.orderBy(F.desc_nulls_last(score), "entity").limit(k)
    # Only the k rows are left, so the unpartitioned window is as small as the report.
    return best.withColumn("rank", F.rank().over(Window.orderBy(F.desc_nulls_last(score))))


def over_event_time(
    fact: DataFrame,
    indicators: DataFrame,
    indicator: str | Sequence[str] | None = None,
    entities: Sequence[str] | None = None,
) -> DataFrame:
    """Series of chosen indicators and entities over event time, with readable names."""
    if indicator is not None:
        chosen = [indicator] if isinstance(indicator, str) else list(indicator)
        fact = fact.filter(F.col("indicator").isin(chosen))
    if entities is not None:
        fact = fact.filter(F.col("entity").isin(list(entities)))
    names = indicators.select("indicator", F.col("name").alias("indicator_name"))
    return (
        fact.join(broadcast_if_small(names), "indicator", "left")
        .withColumn("indicator_name", F.coalesce("indicator_name", "indicator"))
        .orderBy(*EVENT_KEYS, "indicator", "source", "offset")
    )
