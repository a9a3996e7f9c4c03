"""Global row numbers without gathering rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beforeafter.llm.text import unused
from beforeafter.staging import broadcast_if_small, stage


def numbered(df: DataFrame, order: list[Column], groups: list[str] | None = None, name: str = "row_no") -> DataFrame:
    """Adds ``name``: 0, 1, 2 ... in the given order, within each group if any.

    Groups come first in the order. Rows are dealt by range, sorted and written once
    with their partition and place in it; offsets come from one count per partition
    and group, so a hot group is spread over many tasks. Rows that tie in the whole
    order are told apart by their place in the input, which also splits a hot run of
    equal keys; they get different numbers, in no promised order. Null sorts first
    and nulls form one group. An empty frame stays empty.
    """
    groups = groups or []
    part, place, at, p, first, n, shift = (
        unused(x, df.columns) for x in ("_part", "_place", "_at", "_p", "_first", "_n", "_shift")
    )
    copies = [unused(f"_g{i}", df.columns) for i in range(len(groups))]
    keys = [F.col(f"`{g}`").asc_nulls_first() for g in groups] + order
    dealt = (
        df.withColumn(at, F.monotonically_increasing_id())
        .repartitionByRange(*keys, F.col(at))
        .sortWithinPartitions(*keys, F.col(at))
        .withColumn(part, F.spark_partition_id())
        .withColumn(place, F.monotonically_increasing_id() - F.shiftleft(F.col(part).cast("long"), 33))
        .drop(at)
    )
    staged = stage(dealt, "numbered")
    counted = staged.groupBy(part, *groups).agg(F.count(F.lit(1)).alias(n), F.min(place).alias(first))
    # One row per partition and group in it: a partition holds a run of groups, so
    # there are at most as many as partitions and groups together.
    before = Window.partitionBy(*groups).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shifts = counted.select(
        F.col(part).alias(p),
        *[F.col(f"`{g}`").alias(c) for g, c in zip(groups, copies)],
        (F.coalesce(F.sum(n).over(before), F.lit(0)) - F.col(first)).alias(shift),
    )
    on = F.col(part) == F.col(p)
    for g, c in zip(groups, copies):
        on = on & F.col(f"`{g}`").eqNullSafe(F.col(c))
    joined = staged.join(broadcast_if_small(stage(shifts, "shifts")), on)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], (F.col(place) + F.col(shift)).alias(name))
