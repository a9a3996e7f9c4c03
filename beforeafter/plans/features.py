"""From a panel and events to the filtered feature matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame

from beforeafter.operators.correlation import correlated_later, correlation_pairs
from beforeafter.operators.features import drop_indicators, null_filter
from beforeafter.operators.windows import pre_event_means
from beforeafter.staging import stage, stage_side


def dense_features(panel: DataFrame, events: DataFrame, before: int = 6, max_missing: float = 0.5) -> DataFrame:
    """Pre-event means without sparse indicators. The means are staged: they are
    read once for the counts and once for the rows, the panel only once."""
    return null_filter(stage(pre_event_means(panel, events, before), "features"), max_missing)


def training_features(
    panel: DataFrame,
    events: DataFrame,
    before: int = 6,
    max_missing: float = 0.5,
    threshold: float = 0.9,
) -> DataFrame:
    """Pre-event means after the null filter and the correlation filter, in long form."""
    dense = dense_features(panel, events, before, max_missing)
    return drop_indicators(dense, stage_side(correlated_later(correlation_pairs(dense), threshold), "correlated"))
