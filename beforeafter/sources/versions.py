"""Parquet files whose schemas differ, read as one table."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Each type fits into the later ones of its line.
_ORDERS: tuple[tuple[type[T.DataType], ...], ...] = (
    (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DoubleType),
    (T.FloatType, T.DoubleType),
    (T.DateType, T.TimestampNTZType),
    (T.DateType, T.TimestampType),
)


class Group(NamedTuple):
    """Files that share a schema, but for columns that some of them lack."""

    files: list[str]
    schema: T.StructType


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that both fit into: along the widening orders, decimals by their
    digits, structs and arrays by their parts, text where nothing else fits."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    for order in _ORDERS:
        if type(a) in order and type(b) in order:
            return max((a, b), key=lambda t: order.index(type(t)))
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        whole, scale = max(a.precision - a.scale, b.precision - b.scale), max(a.scale, b.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType))
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return united([a, b])
    numbers = (T.NumericType,)
    if isinstance(a, numbers) and isinstance(b, numbers):
        return T.DoubleType()
    return T.StringType()


def united(schemas: list[T.StructType]) -> T.StructType:
    """All columns, in order of their first appearance, ignoring case, at their widest type."""
    found: dict[str, T.StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            key = f.name.lower()
            have = found.get(key)
            found[key] = T.StructField(have.name if have else f.name, wider(have.dataType, f.dataType) if have else f.dataType)
    return T.StructType(list(found.values()))


def schema_groups(spark: SparkSession, path: str) -> list[Group]:
    """The Parquet files under ``path``, oldest first, in runs that one schema fits.

    Spark reads a run's footers in one parallel job; only a run that does not merge is
    halved and tried again. Files of a version are written together, so that takes few
    jobs: about twice the logarithm of the files for each change of schema. The list of
    names is on the driver, as for any scan.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    files = [r["path"] for r in listed.select("path", "modificationTime").orderBy("modificationTime", "path").collect()]

    def runs(part: list[str]) -> Iterator[Group]:
        if not part:
            return
        try:
            yield Group(part, spark.read.option("mergeSchema", True).parquet(*part).schema)
        except (PySparkException, Py4JJavaError) as e:
            if len(part) == 1 or "CANNOT_MERGE_" not in str(e):
                raise
            yield from runs(part[: len(part) // 2])
            yield from runs(part[len(part) // 2 :])

    joined: list[Group] = []
    for group in runs(files):
        # Halves that were parted at the wrong place grow together again.
        same = next((g for g in joined if _agree(g.schema, group.schema)), None)
        if same is None:
            joined.append(group)
        else:
            joined[joined.index(same)] = Group(same.files + group.files, united([same.schema, group.schema]))
    return joined


def _agree(a: T.StructType, b: T.StructType) -> bool:
    types = {f.name: f.dataType for f in a.fields}
    return all(types.get(f.name, f.dataType) == f.dataType for f in b.fields)


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the Parquet files under ``path``, whatever their versions of the schema.

    Each group of files is read with its own schema, so filters and column lists reach
    its scan, and cast to the united one; columns that a version lacks are null. Names
    count without their case, in the spelling of the oldest file. Integers become
    doubles only where some file has doubles (beyond 2**53 they then lose digits); types
    that have nothing in common become text. No file raises.
    """
    groups = schema_groups(spark, path)
    if not groups:
        raise ValueError(f"no Parquet file under {path}")
    target = united([g.schema for g in groups])

    def as_target(group: Group) -> DataFrame:
        have = {f.name.lower(): f.name for f in group.schema.fields}
        df = spark.read.schema(group.schema).parquet(*group.files)
        return df.select(
            *[
                (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in target.fields
            ]
        )

    return reduce(DataFrame.unionByName, map(as_target, groups))
