"""Nested JSON documents as observations and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beforeafter.functions import clean_number


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per JSON file, as text."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "document")


def _entries(df: DataFrame, node: str, key: str, value: str) -> DataFrame:
    """One row per member of the object in ``node``; arrays and scalars give none."""
    members = df.sparkSession.tvf.variant_explode(F.col(node).outer())
    return (
        df.lateralJoin(members)
        .filter(F.col("key").isNotNull())
        .withColumnRenamed("key", key)
        .withColumnRenamed("value", value)
        .drop("pos", node)
    )


def nested_entries(documents: DataFrame, document: str = "document", root: str = "values") -> DataFrame:
    """``{root: {indicator: {entity: {time: value}}}}`` → one row per value, time and
    value still as text; numbers that are not finite and nulls stay, for ``ingest_report``."""
    top = documents.select(F.try_variant_get(F.try_parse_json(document), f"$.{root}", "variant").alias("tree"))
    by_indicator = _entries(top, "tree", "indicator", "entities")
    by_entity = _entries(by_indicator, "entities", "entity", "times")
    by_time = _entries(by_entity, "times", "time", "v")
    return by_time.select("entity", "indicator", "time", F.try_variant_get("v", "$", "string").alias("value"))


def nested_observations(documents: DataFrame, document: str = "document", root: str = "values") -> DataFrame:
    """``nested_entries`` as observations; times or values that are no numbers are left out."""
    return nested_entries(documents, document, root).select(
        "entity",
        "indicator",
        F.col("time").try_cast("int").alias("time"),
        clean_number(F.col("value")).alias("value"),
    ).dropna(subset=["time", "value"])


def catalogue_labels(documents: DataFrame, root: str, document: str = "document") -> DataFrame:
    """``{root: {code: {label}}}`` → code and label; without a label the code stands in."""
    top = documents.select(F.try_variant_get(F.try_parse_json(document), f"$.{root}", "variant").alias("tree"))
    return _entries(top, "tree", "code", "meta").select(
        "code",
        F.coalesce(F.try_variant_get("meta", "$.label", "string"), F.col("code")).alias("label"),
    )
