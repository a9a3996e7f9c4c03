"""Profiles of a growing panel: one stored row per time slice, united when asked for."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Binary logarithm of a sketch's registers.
LG_K = 12
#: Relative standard error of a distinct count, and the one that three of them stay within.
STANDARD_ERROR = 1.04 / 2 ** (LG_K / 2)
STATED_ERROR = 3 * STANDARD_ERROR


def slice_profiles(panel: DataFrame, by: str = "source", width: int = 1) -> DataFrame:
    """One row per ``by`` and slice of ``width`` times: counts, time span and sketches of
    the distinct indicators and entities, in one pass. Rows without a time are slice null."""
    return panel.groupBy(by, F.floor(F.col("time") / width).cast("long").alias("slice")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.hll_sketch_agg("indicator", LG_K).alias("indicators"),
        F.hll_sketch_agg("entity", LG_K).alias("entities"),
        F.min("time").alias("first_time"),
        F.max("time").alias("last_time"),
        F.count_if(F.col("value").isNull()).alias("n_valueless"),
    )


def united_profile(slices: DataFrame, by: str | None = "source") -> DataFrame:
    """The columns of ``profile`` from slices, per ``by`` or over all.

    Rows, times and valueless rows are exact; distinct counts are estimates with a
    relative standard error of ``STANDARD_ERROR``. Slices unite in any order and
    grouping, so a profile of years is one of its days.
    """
    measures = [
        F.sum("n_rows").alias("n_rows"),
        F.hll_sketch_estimate(F.hll_union_agg("indicators")).alias("n_indicators"),
        F.hll_sketch_estimate(F.hll_union_agg("entities")).alias("n_entities"),
        F.min("first_time").alias("first_time"),
        F.max("last_time").alias("last_time"),
        F.sum("n_valueless").alias("n_valueless"),
    ]
    return slices.groupBy(by).agg(*measures) if by else slices.agg(*measures)


def stored_slices(spark: SparkSession, root: str) -> DataFrame | None:
    """The slices kept under ``root``; none before the first."""
    try:
        return spark.read.parquet(root)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def refresh_profiles(
    panel: DataFrame, root: str, by: str = "source", width: int = 1, again: tuple[int, ...] = ()
) -> DataFrame:
    """Profiles what is new and returns all slices under ``root``.

    New are slices behind the greatest one stored, which itself counts as unfinished and
    is profiled anew; ``again`` names earlier ones that have changed since. The time
    filter reaches the panel's scan, so a refresh reads those slices only; each is
    replaced as a whole. Rows without a time are profiled by the first refresh and
    whenever ``again`` holds a slice. Later columns of the same slices change nothing.
    """
    spark = panel.sparkSession
    before = stored_slices(spark, root)
    newest = before.agg(F.max("slice").alias("s")).first()["s"] if before is not None else None
    wanted = panel
    if newest is not None:
        condition = F.col("time") >= newest * width
        for s in again:
            condition = condition | ((F.col("time") >= s * width) & (F.col("time") < (s + 1) * width))
        wanted = panel.filter(condition | F.col("time").isNull() if again else condition)
    slices = slice_profiles(wanted, by, width)
    slices.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slice").parquet(root)
    return spark.read.parquet(root)
