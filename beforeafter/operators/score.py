"""Readiness score of candidates against reference rows on given axes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beforeafter.functions import interpolate, status_label

# Axis weights, and the scores of the lowest, mean and highest reference row.
WEIGHTS = (1.5, 1.0)
LEVELS = (20.0, 50.0, 95.0)


def completeness(candidates: DataFrame, indicators: DataFrame) -> DataFrame:
    """``entity, data_completeness``: the share of the listed indicators with a value.

    Candidate values must be unique per entity and indicator, as a snapshot's are.
    """
    total = indicators.agg(F.count(F.lit(1))).scalar()
    listed = candidates.join(indicators.select("indicator", F.lit(True).alias("listed")), "indicator", "left")
    present = listed.groupBy("entity").agg(F.count_if(F.col("listed") & F.col("value").isNotNull()).alias("n"))
    return present.select("entity", (F.col("n") / F.nullif(total, F.lit(0))).alias("data_completeness"))


def add_readiness(
    candidates: DataFrame,
    reference: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    levels: Sequence[float] = LEVELS,
) -> DataFrame:
    """Adds ``lead, raw_score, readiness, degenerate`` to frames with ``axis_1 ..``.

    The raw score is the weighted sum of a row's offsets from the reference
    centroid, so the centroid scores 0. It is mapped linearly between the lowest,
    mean and highest reference row. If these coincide the score is the middle
    level and ``degenerate`` is true.
    """
    mixed = sum((F.col(f"axis_{i + 1}") * w for i, w in enumerate(weights)), F.lit(0.0))
    figures = reference.agg(
        F.struct(
            F.avg("axis_1").alias("centre"),
            F.min(mixed).alias("lo"),
            F.avg(mixed).alias("mid"),
            F.max(mixed).alias("hi"),
        ).alias("figures")
    ).scalar()
    lo, mid, hi = (F.col(f"figures.{c}") for c in ("lo", "mid", "hi"))
    middle = F.lit(float(levels[1]))
    knots = [
        (lo - mid, F.lit(float(levels[0]))),
        (F.lit(0.0), middle),
        (hi - mid, F.lit(float(levels[2]))),
    ]
    return (
        candidates.withColumn("figures", figures)
        .withColumn("lead", F.col("axis_1") - F.col("figures.centre"))
        .withColumn("raw_score", mixed - mid)
        .withColumn("degenerate", lo == hi)
        .withColumn(
            "readiness", F.when(F.col("degenerate"), middle).otherwise(interpolate(F.col("raw_score"), knots))
        )
        .drop("figures")
    )


def score_rows(scored: DataFrame, complete: DataFrame) -> DataFrame:
    """The result row per candidate: label, completeness and score, rounded."""
    return scored.join(complete, "entity", "left").select(
        "entity",
        F.col("anomaly_label").cast("int").alias("anomaly_label"),
        F.round("data_completeness", 4).alias("data_completeness"),
        F.round("readiness", 2).alias("readiness_score"),
    )


def evaluate(scored: DataFrame, asked: DataFrame) -> DataFrame:
    """Status and report text for the asked ``entity`` ids; unknown ids are reported as such."""
    found = F.col("readiness").isNotNull()
    status = F.when(found, status_label(F.col("anomaly_label"), F.col("lead")))
    joined = asked.select("entity").distinct().join(scored, "entity", "left")
    return joined.withColumn("status", status).select(
        "entity",
        "anomaly_label",
        F.round("readiness", 2).alias("readiness_score"),
        "status",
        F.when(
            found,
            F.format_string("%s: %s, viability index %.1f / 100", "entity", "status", "readiness"),
        )
        .otherwise(F.format_string("%s: not found", "entity"))
        .alias("report"),
    )
