"""Feature tables in long form, ``entity, event_at, indicator, avg_value``, and the wide output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beforeafter.functions import quoted
from beforeafter.schema import EVENT_KEYS
from beforeafter.staging import stage_side


def missing_counts(features: DataFrame) -> DataFrame:
    """Rows without a value per indicator; a row counts if it has data for any indicator."""
    n_rows = features.agg(F.count_distinct(*EVENT_KEYS)).scalar()
    return features.groupBy("indicator").agg(F.count("avg_value").alias("n_values")).select(
        "indicator", n_rows.alias("n_rows"), (n_rows - F.col("n_values")).alias("n_missing")
    )


def dense_enough(features: DataFrame, max_missing: float = 0.5) -> DataFrame:
    """Indicators missing on at most that share of rows."""
    return missing_counts(features).filter(F.col("n_missing") <= max_missing * F.col("n_rows")).select("indicator")


def keep_indicators(df: DataFrame, indicators: DataFrame) -> DataFrame:
    """Rows of the listed indicators. The caller hints the list if it is small."""
    return df.join(indicators, "indicator", "left_semi")


def drop_indicators(df: DataFrame, indicators: DataFrame) -> DataFrame:
    return df.join(indicators, "indicator", "left_anti")


def null_filter(features: DataFrame, max_missing: float = 0.5) -> DataFrame:
    return keep_indicators(features, stage_side(dense_enough(features, max_missing), "dense-enough"))


def common_indicators(a: DataFrame, b: DataFrame) -> DataFrame:
    """Indicators present on both sides."""
    return a.select("indicator").distinct().join(b.select("indicator").distinct(), "indicator", "left_semi")


def wide_matrix(
    features: DataFrame,
    indicators: Sequence[str] | None = None,
    keys: Sequence[str] = EVENT_KEYS,
    value: str = "avg_value",
    max_columns: int = 10_000,
) -> DataFrame:
    """One row per key, one column per indicator in code order.

    A column per code is a driver-side schema, so this refuses more than
    ``max_columns`` of them; the long form has no such bound.
    """
    if indicators is None:
        codes = features.select("indicator").distinct().orderBy("indicator").limit(max_columns + 1).collect()
        indicators = [r["indicator"] for r in codes]
    if len(indicators) > max_columns:
        raise ValueError(f"more than {max_columns} indicators: use the long form")
    wide = features.groupBy(*keys).pivot("indicator", list(indicators)).agg(F.first(value, ignorenulls=True))
    return wide.select(*keys, *[quoted(c) for c in indicators])
