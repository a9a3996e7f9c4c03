"""Column names and fixed schemas shared by all operators."""

from __future__ import annotations

from pyspark.sql import types as T

PANEL_COLUMNS = ("source", "entity", "indicator", "time", "value")
PANEL_KEYS = ("source", "entity", "indicator", "time")
EVENT_KEYS = ("entity", "event_at")
SERIES_KEYS = ("entity", "event_at", "source", "indicator")
FACT_COLUMNS = (
    "entity",
    "event_at",
    "offset",
    "time",
    "indicator",
    "source",
    "value",
    "baseline_value",
    "pct_change",
)

# Observations as landed, before a source tag is added.
OBSERVATIONS = T.StructType(
    [
        T.StructField("entity", T.StringType(), False),
        T.StructField("indicator", T.StringType(), False),
        T.StructField("time", T.IntegerType(), False),
        T.StructField("value", T.DoubleType(), True),
    ]
)

LABELS = T.StructType(
    [
        T.StructField("indicator", T.StringType(), False),
        T.StructField("label", T.StringType(), True),
    ]
)

FACT = T.StructType(
    [
        T.StructField("entity", T.StringType()),
        T.StructField("event_at", T.IntegerType()),
        T.StructField("offset", T.IntegerType()),
        T.StructField("time", T.IntegerType()),
        T.StructField("indicator", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("baseline_value", T.DoubleType()),
        T.StructField("pct_change", T.DoubleType()),
    ]
)

SCORES = T.StructType(
    [
        T.StructField("entity", T.StringType()),
        T.StructField("anomaly_label", T.IntegerType()),
        T.StructField("data_completeness", T.DoubleType()),
        T.StructField("readiness_score", T.DoubleType()),
    ]
)

ENTITY_DIM = T.StructType(
    [
        T.StructField("entity", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("income_group", T.StringType()),
    ]
)

INDICATOR_DIM = T.StructType(
    [
        T.StructField("indicator", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)
