"""Match a frame to a target schema and set aside rows that do not cast."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beforeafter.functions import quoted
from beforeafter.sinks.publish import commit, live_run


class Conformed(NamedTuple):
    good: DataFrame
    rejected: DataFrame
    missing: list[str]
    extra: list[str]


def _matches(df: DataFrame, schema: T.StructType) -> dict[str, str | None]:
    """Target name → name in ``df``, ignoring case."""
    have: dict[str, str] = {}
    for name in df.columns:
        if name.lower() in have:
            raise ValueError(f"two columns named {name!r} but for case")
        have[name.lower()] = name
    return {f.name: have.get(f.name.lower()) for f in schema.fields}


def _cast(df: DataFrame, schema: T.StructType) -> tuple[list[Column], Column]:
    """The target columns cast, NULL for missing ones, and the names of those whose
    value was there but did not cast."""
    matches = _matches(df, schema)
    cast, failed = [], []
    for field in schema.fields:
        name = matches[field.name]
        if name is None:
            cast.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value = quoted(name).try_cast(field.dataType)
        cast.append(value.alias(field.name))
        failed.append(F.when(quoted(name).isNotNull() & value.isNull(), F.lit(field.name)))
    return cast, F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")


def split_rejects(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows that cast to the schema, and the others.

    The good rows have the target columns, with NULL for missing ones. A rejected
    row keeps its own columns and names, in ``rejected``, the target columns whose
    value was there but did not cast.
    """
    cast, names = _cast(df, schema)
    return df.filter(F.size(names) == 0).select(*cast), df.filter(F.size(names) > 0).withColumn("rejected", names)


def conform(df: DataFrame, schema: T.StructType) -> Conformed:
    """Columns by name ignoring case: missing ones as NULL, extra ones dropped, both listed."""
    matches = _matches(df, schema)
    used = {name for name in matches.values() if name}
    good, rejected = split_rejects(df, schema)
    return Conformed(
        good,
        rejected,
        [target for target, name in matches.items() if name is None],
        [c for c in df.columns if c not in used],
    )


def load(df: DataFrame, schema: T.StructType, root: str) -> DataFrame:
    """Replace the typed table under ``root``; rows that do not cast are set aside.

    The source is read once: good and rejected rows go to one new run folder, parted
    by a flag, and are counted while they are written. One small file then makes the
    run live, so a failure before it leaves the former rows and rejects in place.
    Returns one row: ``n_loaded, n_rejected, missing, extra``.
    """
    spark = df.sparkSession
    plan = conform(df, schema)
    cast, names = _cast(df, schema)
    bad = F.size(names) > 0
    source = F.struct(*[quoted(c) for c in df.columns])
    flagged = df.select(
        F.when(~bad, F.struct(*cast)).alias("row"),
        F.when(bad, source).alias("source"),
        F.when(bad, names).alias("rejected"),
        bad.alias("is_rejected"),
    )
    seen = Observation()
    run = uuid.uuid4().hex
    path = f"{root}/runs/{run}/rows"
    flagged.observe(
        seen, F.count_if(~F.col("is_rejected")).alias("good"), F.count_if("is_rejected").alias("bad")
    ).write.partitionBy("is_rejected").parquet(path)
    counts = seen.get
    commit(spark, root, [(run, "rows", path, counts["good"] + counts["bad"], flagged.schema.simpleString())])
    return spark.createDataFrame(
        [(counts["good"], counts["bad"], plan.missing, plan.extra)],
        "n_loaded long, n_rejected long, missing array<string>, extra array<string>",
    )


def loaded(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The live rows of a ``load``; none before the first."""
    rows = _live(spark, root, T.StructType([T.StructField("row", schema), T.StructField("is_rejected", T.BooleanType())]))
    return rows.filter(~F.col("is_rejected")).select("row.*")


def load_rejects(spark: SparkSession, root: str, source: T.StructType) -> DataFrame:
    """The live rejects of a ``load``: the source's columns, and ``rejected``."""
    fields = [("source", source), ("rejected", T.ArrayType(T.StringType())), ("is_rejected", T.BooleanType())]
    rows = _live(spark, root, T.StructType([T.StructField(n, t) for n, t in fields]))
    return rows.filter("is_rejected").select("source.*", "rejected")


def _live(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    run = live_run(spark, root).filter(F.col("name") == "rows").first()
    return spark.read.schema(schema).parquet(run["path"]) if run else spark.createDataFrame([], schema)
