"""Checks and choices on files before a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class EmptyInput(ValueError):
    """An input is missing columns, has other types or holds no row."""


def schema_of(spark: SparkSession, path: str, merge: bool = False) -> DataFrame:
    """Columns and types as found in the files: ``position, name, type``."""
    schema = spark.read.option("mergeSchema", merge).parquet(path).schema
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(schema.fields)]
    return spark.createDataFrame(rows, "position int, name string, type string")


def read_matching(spark: SparkSession, path: str, glob: str | None = None, regex: str | None = None) -> DataFrame:
    """Parquet files under ``path`` picked by a glob on the file name or a regex on the full path."""
    reader = spark.read.option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.parquet(path)
    return df.filter(F.col("_metadata.file_path").rlike(regex)) if regex else df


def input_report(df: DataFrame, wanted: T.StructType, name: str = "input") -> DataFrame:
    """One row per wanted column: is it there, has it the type, how many rows and values."""
    have = {f.name.lower(): f for f in df.schema.fields}
    found = [(f, have.get(f.name.lower())) for f in wanted.fields]
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(F.col(f"`{h.name}`")).alias(f"n_{i}") for i, (_, h) in enumerate(found) if h],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("input"),
                F.lit(f.name).alias("name"),
                F.lit(h is not None).alias("present"),
                F.lit(h is not None and h.dataType == f.dataType).alias("type_ok"),
                F.col("n_rows"),
                (F.col(f"n_{i}") if h else F.lit(0).cast("long")).alias("n_values"),
            )
            for i, (f, h) in enumerate(found)
        ]
    )
    return counts.select(F.inline(entries))


def require_input(df: DataFrame, wanted: T.StructType, name: str = "input") -> DataFrame:
    """The report of ``input_report``; raises ``EmptyInput`` if the input cannot be used."""
    report = input_report(df, wanted, name)
    # One row per wanted column, so this is as small as the schema.
    bad = [r for r in report.collect() if not (r["present"] and r["type_ok"] and r["n_rows"])]
    if bad:
        raise EmptyInput(f"{name}: " + "; ".join(f"{r['name']} of {r['n_rows']} rows" for r in bad))
    return report
