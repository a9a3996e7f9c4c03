"""Mix sources to target weights: capped water-filling and seeded repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beforeafter.llm.ranks import numbered
from beforeafter.llm.text import unused
from beforeafter.staging import broadcast_if_small, stage

#: Starts tried for each source.
STARTS = 16


def cyclic_weights(sources: DataFrame, cycle: tuple[float, ...]) -> DataFrame:
    """``source`` and ``weight``: the cycle dealt over the sources by code point, null last."""
    rows = numbered(sources.select("source").distinct(), [F.col("source").asc_nulls_last()], name="_no")
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    return rows.select("source", F.element_at(weights, (F.pmod("_no", F.lit(len(cycle))) + 1).cast("int")).alias("weight"))


def water_filled(sources: DataFrame, budget: float) -> DataFrame:
    """Adds ``target``: the budget shared by ``weight``, none above its ``cap``.

    Sources whose share passes the cap are clamped to it and the excess is shared by
    weight among the rest, until no share passes. Each round is one aggregate over the
    sources; only its three sums reach the driver. A budget above all caps together
    gives every source its cap.
    """
    level, clamped = 0.0, -1
    while True:
        full = F.col("cap") <= F.col("weight") * level
        sums = sources.agg(
            F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0.0)).alias("held"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("open"),
            F.count(F.when(full, True)).alias("n"),
        ).first()
        if sums["n"] == clamped:
            break
        clamped = sums["n"]
        if not sums["open"]:
            return sources.withColumn("target", F.col("cap"))
        level = max(0.0, budget - sums["held"]) / sums["open"]
    return sources.withColumn("target", F.least("cap", F.col("weight") * level))


def mix(
    df: DataFrame,
    size: Column,
    cycle: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = 23,
    carry: list[str] | None = None,
    source_col: str = "source",
) -> DataFrame:
    """Adds ``size``, ``source_size``, ``target`` and ``copies`` to each row.

    The sources share ``share`` times all sizes by cyclic weights, each at most
    ``max_epochs`` times its own size. With e epochs due, a row is taken floor(e) or
    ceil(e) whole times: rows of a source are put in order of size, then of a seeded
    hash of the row, and row r (from 0) takes floor(e (r + 1) + u) - floor(e r + u)
    copies. Over rows ordered by size the differences cancel, so the words taken miss
    the target by at most one largest row, whatever the source; of ``STARTS`` evenly
    spaced starts u from a seeded one, each source takes the one that misses least. Null sources form one source; null sizes count 0; a source of size 0 has
    target 0; repeated rows are rows of their own. ``carry`` names the columns kept
    (default all); columns of the new names are replaced.
    """
    new = ("size", "source_size", "target", "copies")
    carry = [c for c in (df.columns if carry is None else carry) if c.lower() not in new]
    # Written once: sizes and row ids stay the same however often they are read.
    rows = stage(
        df.select(
            F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
            F.col(f"`{source_col}`").alias("source"),
            F.coalesce(size, F.lit(0)).cast("long").alias("size"),
            F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in df.columns if _hashable(df, c)]).alias("_tie"),
            F.monotonically_increasing_id().alias("uid"),
        ),
        "mix-rows",
    )
    narrow = rows.select("source", "size", "_tie", "uid")
    totals = stage(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    weighted = totals.join(
        broadcast_if_small(cyclic_weights(totals, cycle)).withColumnRenamed("source", "_s"),
        F.col("source").eqNullSafe(F.col("_s")),
    ).select("source", "source_size", "weight", (F.col("source_size") * float(max_epochs)).alias("cap"))
    weighted = stage(weighted, "mix-weights")
    budget = share * (totals.agg(F.sum("source_size")).first()[0] or 0)
    plan = water_filled(weighted, budget).select(
        F.col("source").alias("_s"),
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("_epochs"),
        (F.pmod(F.xxhash64("source", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)).alias("_start"),
    )
    plan = broadcast_if_small(stage(plan, "mix-plan"))
    ranked = numbered(narrow, [F.col("size").asc(), F.col("_tie").asc()], groups=["source"], name="_rank")
    ranked = ranked.join(plan, F.col("source").eqNullSafe(F.col("_s")))

    def due(start: Column) -> Column:
        after, before = F.col("_epochs") * (F.col("_rank") + 1), F.col("_epochs") * F.col("_rank")
        return (F.floor(after + start) - F.floor(before + start)).cast("long")

    starts = [F.pmod(F.col("_start") + k / STARTS, F.lit(1.0)) for k in range(STARTS)]
    sums = ranked.groupBy("source").agg(
        F.first("target").alias("_t"), F.first("_start").alias("_b"), *[F.sum(F.col("size") * due(s)).alias(f"_{k}") for k, s in enumerate(starts)]
    )
    nearest = F.array_min(F.array(*[F.struct(F.abs(F.col(f"_{k}") - F.col("_t")).alias("miss"), F.lit(k).alias("k")) for k in range(STARTS)]))
    picked = sums.select(F.col("source").alias("_s2"), F.pmod(F.col("_b") + nearest["k"] / float(STARTS), F.lit(1.0)).alias("_u0"))
    picked = broadcast_if_small(stage(picked, "mix-starts"))
    taken = ranked.join(picked, F.col("source").eqNullSafe(F.col("_s2"))).select(
        F.col("uid").alias("_u"), "source_size", "target", due(F.col("_u0")).alias("copies")
    )
    taken = stage(taken, "mix-copies")
    back = rows.join(broadcast_if_small(taken), F.col("uid") == F.col("_u"))
    return back.select(*[F.col("row")[c].alias(c) for c in carry], "size", "source_size", "target", "copies")


def _hashable(df: DataFrame, name: str) -> bool:
    return "map<" not in df.schema[name].dataType.simpleString()


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: each row as often as its ``copies`` say."""
    again = unused("_again", mixed.columns)
    return (
        mixed.filter(F.col("copies") > 0)
        .withColumn(again, F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select(*[F.col(f"`{c}`") for c in columns])
    )
