"""Dimension tables for indicators and entities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beforeafter.staging import stage_side

# Names of indicators that the second source does not describe itself.
KNOWN_NAMES = {
    "NGDP_RPCH": "Real GDP Growth (%)",
    "PCPIPCH": "Inflation Rate (%)",
    "LUR": "Unemployment Rate (%)",
    "BCA": "Current Account Balance (USD bn)",
    "GGXWDG_NGDP": "Government Debt (% of GDP)",
    "BCA_GDP": "Current Account Balance (% of GDP)",
    "AI_PI": "Price Index",
}


def known_names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(KNOWN_NAMES.items()), "code string, label string")


def dim_indicator(codes: DataFrame, ladder: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """``indicator, name, source`` for the distinct codes of a fact.

    Each rung is a ``code, label`` table and its source; the first rung that knows
    a code names it, and a code no rung knows stands for itself, source 'Unknown'.
    """
    out = codes.select("indicator").distinct()
    name: Column = F.lit(None).cast("string")
    source: Column = F.lit(None).cast("string")
    for i, (labels, tag) in enumerate(ladder):
        rung = labels.groupBy(F.col("code").alias("indicator")).agg(
            F.max(F.coalesce("label", "code")).alias(f"label_{i}")
        )
        out = out.join(stage_side(rung, "labels"), "indicator", "left")
        name = F.coalesce(name, F.col(f"label_{i}"))
        source = F.coalesce(source, F.when(F.col(f"label_{i}").isNotNull(), F.lit(tag)))
    return out.select(
        "indicator",
        F.coalesce(name, F.col("indicator")).alias("name"),
        F.coalesce(source, F.lit("Unknown")).alias("source"),
    ).orderBy("indicator")


def dim_entity(
    catalogue: DataFrame, entity: str = "id", name: str = "value", region: str = "region", income: str = "incomeLevel"
) -> DataFrame:
    """``entity, name, region, income_group``; missing texts become empty."""
    return catalogue.select(
        F.col(entity).cast("string").alias("entity"),
        F.col(name).cast("string").alias("name"),
        F.coalesce(F.col(region).cast("string"), F.lit("")).alias("region"),
        F.coalesce(F.col(income).cast("string"), F.lit("")).alias("income_group"),
    )
