"""Panels and events derived from the supplied sales and activity tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beforeafter.functions import time_index
from beforeafter.schema import PANEL_COLUMNS
from beforeafter.sources import tag_source
from beforeafter.sources.panel import events_from


# Schemas of the supplied tables that the queries read.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def cents(amount: Column) -> Column:
    """Amounts as whole cents, so that sums do not hang on the order of rows."""
    return F.round(amount * 100).cast("long")


def total(amount: Column) -> Column:
    return F.sum(cents(amount)) / 100.0


def mean(amount: Column) -> Column:
    return F.sum(cents(amount)) / 100.0 / F.count(amount)


def orders_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly order value per nation and order priority."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    buyers = _buyers(spark, sf_dir)
    rows = (
        orders.join(buyers, orders.o_custkey == buyers.c_custkey)
        .groupBy(
            F.col("n_name").alias("entity"),
            F.col("o_orderpriority").alias("indicator"),
            time_index(F.col("o_orderdate"), "month").alias("time"),
        )
        .agg(total(F.col("o_totalprice")).alias("value"))
    )
    return tag_source(rows, "ORD").select(*PANEL_COLUMNS)


def items_panel(spark: SparkSession, sf_dir: str, by_flag: bool = False) -> DataFrame:
    """Monthly mean item price per nation and brand, or per brand and return flag."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_shipdate", "l_extendedprice", "l_returnflag"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    buyers = _buyers(spark, sf_dir)
    # Orders meet their buyers first, so the items shuffle once for both.
    placed = orders.join(buyers, orders.o_custkey == buyers.c_custkey).select("o_orderkey", "n_name")
    code = ["B", F.col("p_brand"), F.col("l_returnflag")] if by_flag else ["B", F.col("p_brand")]
    rows = (
        items.join(placed, items.l_orderkey == placed.o_orderkey)
        .join(parts, F.col("l_partkey") == parts.p_partkey)
        .groupBy(
            F.col("n_name").alias("entity"),
            F.concat_ws(".", *[F.lit(c) if isinstance(c, str) else c for c in code]).alias("indicator"),
            time_index(F.col("l_shipdate"), "month").alias("time"),
        )
        .agg(mean(F.col("l_extendedprice")).alias("value"))
    )
    return tag_source(rows, "LI").select(*PANEL_COLUMNS)


def _buyers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return customers.join(nations, customers.c_nationkey == nations.n_nationkey).select("c_custkey", "n_name")


def raw_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every activity row as an observation: a user has many per day and type."""
    return tag_source(
        table(spark, sf_dir, "events").select(
            F.col("user_id").cast("string").alias("entity"),
            F.col("event_type").alias("indicator"),
            time_index(F.col("ts"), "day").alias("time"),
            "value",
        ),
        "EV",
    ).select(*PANEL_COLUMNS)


def activity_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily activity value per user and type."""
    keys = ["source", "entity", "indicator", "time"]
    return raw_activity(spark, sf_dir).groupBy(*keys).agg(total(F.col("value")).alias("value"))


def nation_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event per nation, in consecutive months from the start of 1998."""
    nations = table(spark, sf_dir, "nation")
    month = F.lit(1998 * 12) + F.col("n_nationkey")
    return events_from(nations.select("n_name", month.alias("month")), "n_name", "month")


def signup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day of each user's first signup."""
    first = (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type") == "signup")
        .groupBy("user_id")
        .agg(F.min(time_index(F.col("ts"), "day")).alias("day"))
    )
    return events_from(first, "user_id", "day")
