"""Exact medians per key, whatever the share of rows one key holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from beforeafter.staging import broadcast_if_small, stage

_EDGES = 255


def exact_median(
    df: DataFrame, key: str = "indicator", value: str = "value", group_limit: int = 10_000
) -> DataFrame:
    """``key, median``: the mean of the two middle values if their number is even.

    Keys with at most ``group_limit`` values use the built-in percentile, which
    keeps a key's distinct values in one task. Larger keys are narrowed down: each
    round counts the rows between approximate quantiles, exactly, and keeps the
    interval that holds the middle rank, so no task sees more than the counts.
    """
    data = df.select(F.col(key).alias("k"), F.col(value).alias("v")).dropna()
    sizes = data.groupBy("k").agg(F.count("v").alias("n"))
    if (sizes.agg(F.max("n").alias("n")).first()["n"] or 0) <= group_limit:
        return data.groupBy("k").agg(F.percentile("v", 0.5).alias("median")).withColumnRenamed("k", key)
    sizes = stage(sizes, "median-sizes")
    big = sizes.filter(F.col("n") > group_limit)
    few = data.join(broadcast_if_small(big.select("k")), "k", "left_anti")
    small = few.groupBy("k").agg(F.percentile("v", 0.5).alias("median"))
    return small.unionByName(_narrowed(data, big)).withColumnRenamed("k", key)


def _narrowed(data: DataFrame, big: DataFrame) -> DataFrame:
    """Medians of the big keys by narrowing the interval of each middle rank."""
    middle = F.array_distinct(F.array(F.floor((F.col("n") - 1) / 2), F.ceil((F.col("n") - 1) / 2)))
    bounds = data.groupBy("k").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    state = big.join(bounds, "k").select(
        "k", F.explode(middle).alias("rank"), "lo", "hi", F.lit(0).cast("long").alias("below")
    )
    state = stage(state, "median-round")
    per_rank = Window.partitionBy("k", "rank").orderBy("bin")
    while state.filter("lo < hi").limit(1).count():
        open_ = state.filter("lo < hi")
        inside = data.join(broadcast_if_small(open_), "k").filter("v between lo and hi")
        edges = inside.groupBy("k", "rank").agg(
            F.percentile_approx("v", [i / (_EDGES + 1) for i in range(1, _EDGES + 1)], 10_000).alias("edges")
        )
        # At most 255 edges per open rank; edges are data values with bins of their own.
        split = inside.join(_spread(edges), ["k", "rank"]).withColumn(
            "bin",
            F.size(F.filter("edges", lambda e: e < F.col("v"))) + F.size(F.filter("edges", lambda e: e <= F.col("v"))),
        )
        bins = split.groupBy("k", "rank", "bin").agg(
            F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.first("below").alias("below")
        )
        before = F.coalesce(F.sum("n").over(per_rank.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        picked = (
            bins.withColumn("below", F.col("below") + before)
            .filter((F.col("rank") >= F.col("below")) & (F.col("rank") < F.col("below") + F.col("n")))
            .select("k", "rank", "lo", "hi", "below")
        )
        state = stage(state.filter("lo = hi").unionByName(picked), "median-round")
    return state.groupBy("k").agg(F.avg("lo").alias("median"))


def _spread(edges: DataFrame, limit: int = 20_000) -> DataFrame:
    """Broadcast the edge lists while their number is small (2 KB each)."""
    edges = stage(edges, "median-edges")
    return F.broadcast(edges) if edges.count() <= limit else edges
