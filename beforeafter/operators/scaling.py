"""Log, fill and scale with figures learnt on reference rows only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beforeafter.functions import signed_log
from beforeafter.operators.features import keep_indicators
from beforeafter.operators.medians import exact_median
from beforeafter.schema import EVENT_KEYS
from beforeafter.staging import broadcast_if_small

# Rows filled at a time.
SLICE = 1_024


def reference_stats(
    reference: DataFrame,
    indicators: DataFrame,
    keys: Sequence[str] = EVENT_KEYS,
    group_limit: int = 10_000,
) -> DataFrame:
    """``indicator, median, mean, spread`` of the signed logs of reference rows.

    Mean and population spread are those after filling gaps with the median, so a
    reference row counts even where it has no value; this follows from counts,
    means and variances, without building the filled grid. An unvarying indicator
    has spread 1, one with no value at all is left out.
    """
    n_rows = reference.agg(F.count_distinct(*keys)).scalar()
    logs = (
        keep_indicators(reference, indicators)
        .dropna(subset=["value"])
        .select("indicator", signed_log(F.col("value")).alias("x"))
    )
    moments = logs.groupBy("indicator").agg(
        F.count("x").alias("n"),
        F.avg("x").alias("m"),
        F.var_pop("x").alias("v"),
        F.min("x").alias("lo"),
        F.max("x").alias("hi"),
    )
    medians = exact_median(logs, "indicator", "x", group_limit)
    gaps = n_rows - F.col("n")
    mean = (F.col("n") * F.col("m") + gaps * F.col("median")) / n_rows
    variance = (
        F.col("n") * (F.col("v") + F.pow(F.col("m") - F.col("mean"), 2))
        + gaps * F.pow(F.col("median") - F.col("mean"), 2)
    ) / n_rows
    return (
        moments.join(medians, "indicator")
        .withColumn("mean", mean)
        .withColumn("spread", F.when(F.col("lo") == F.col("hi"), 1.0).otherwise(F.sqrt(variance)))
        .select("indicator", "median", "mean", "spread")
    )


@dataclass(frozen=True)
class Scaling:
    """One figure of each kind per indicator, in code order: the width of a row."""

    indicators: list[str]
    median: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    @classmethod
    def of(cls, stats: DataFrame) -> "Scaling":
        # As many rows as a scaled row has numbers.
        rows = stats.orderBy("indicator").collect()
        return cls(
            [r["indicator"] for r in rows],
            np.array([r["median"] for r in rows], dtype=float),
            np.array([r["mean"] for r in rows], dtype=float),
            np.array([r["spread"] for r in rows], dtype=float),
        )

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (c, i, float(m), float(s))
            for i, (c, m, s) in enumerate(zip(self.indicators, self.mean, self.spread))
        ]
        return spark.createDataFrame(rows, "indicator string, slot int, mean double, spread double")

    @property
    def width(self) -> int:
        return len(self.indicators)


def scaled_rows(long: DataFrame, scaling: Scaling, keys: Sequence[str]) -> DataFrame:
    """One row per key with ``z``, the filled and scaled values in code order.

    Keys without any known indicator still get a row, of medians. The values of a
    key must be unique per indicator, so a row gathers at most ``width`` of them; a
    repeated one raises.
    """
    x = signed_log(F.col("value"))
    cell = F.when(
        F.col("slot").isNotNull() & F.col("value").isNotNull(),
        F.struct("slot", ((x - F.col("mean")) / F.col("spread")).alias("z")),
    )
    table = broadcast_if_small(scaling.table(long.sparkSession))
    cells = long.join(table, "indicator", "left").groupBy(*keys).agg(F.collect_list(cell).alias("cells"))
    gap = (scaling.median - scaling.mean) / scaling.spread

    @F.pandas_udf("array<double>")
    def filled(slots: pd.Series, values: pd.Series) -> pd.Series:
        out = []
        for at in range(0, len(slots), SLICE):
            some, known = slots.iloc[at : at + SLICE], values.iloc[at : at + SLICE]
            z = np.tile(gap, (len(some), 1))
            lengths = some.map(len).to_numpy()
            if lengths.sum():
                z[np.repeat(np.arange(len(some)), lengths), np.concatenate(some.to_list())] = np.concatenate(known.to_list())
            out += list(z)
        return pd.Series(out, dtype=object)

    at = F.col("cells.slot")
    unique = F.when(F.size(F.array_distinct(at)) < F.size(at), F.raise_error(F.lit("repeated key and indicator"))).otherwise(at)
    return cells.select(*keys, filled(unique, F.col("cells.z")).alias("z"))


def scaled_long(rows: DataFrame, scaling: Scaling, keys: Sequence[str]) -> DataFrame:
    """``scaled_rows`` output as one row per key and indicator."""
    names = broadcast_if_small(scaling.table(rows.sparkSession).select("slot", "indicator"))
    cells = rows.select(*keys, F.posexplode("z").alias("slot", "scaled"))
    return cells.join(names, "slot").select(*keys, "indicator", "scaled")
