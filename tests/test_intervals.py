"""Interval joins against comparing every point with every interval."""

import random

import pytest
from pyspark.sql import functions as F

from beforeafter.operators.intervals import band_join, interval_join, micros
import beforeafter.staging as staging

POINTS = "key string, other int, at long, p int"
SPANS = "key string, other int, first long, last long, s int"


def made():
    pick = random.Random(2)
    keys = ["hot"] * 6 + ["a", "b", None]
    points = [(pick.choice(keys), pick.choice([1, 1, None]), pick.choice([None, *[pick.randint(-3000, 3000)] * 9]), i) for i in range(900)]
    spans = []
    for i in range(300):
        first = pick.randint(-3000, 3000)
        length = pick.choice([0, 0, 1, 2, 3, 7, 8, 9, 500, 5000, -1, 2**40])
        spans.append((pick.choice(keys), pick.choice([1, 1, None]), first, first + length, i))
    spans += [("a", 1, None, 5, 900), ("a", 1, 5, None, 901), *spans[:9]]
    return points + points[:20], spans


def by_hand(points, spans):
    return sorted(
        (p[3], s[4]) for p in points for s in spans
        if None not in (p[0], p[1], p[2], s[2], s[3]) and p[:2] == s[:2] and s[2] <= p[2] <= s[3]
    )


def test_interval_join_equals_all_comparisons(spark):
    points, spans = made()
    joined = interval_join(spark.createDataFrame(points, POINTS), spark.createDataFrame(spans, SPANS), ["key", "other"], "at", "first", "last")
    assert sorted((r["p"], r["s"]) for r in joined.collect()) == by_hand(points, spans)
    assert set(joined.columns) == {"key", "other", "at", "p", "first", "last", "s"}
    empty = spark.createDataFrame([], SPANS)
    assert interval_join(spark.createDataFrame(points, POINTS), empty, ["key", "other"], "at", "first", "last").count() == 0


def test_interval_join_without_broadcast_has_no_nested_loop(spark, monkeypatch):
    monkeypatch.setattr(staging.broadcast_if_small, "__defaults__", (-1,))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        points, spans = made()
        joined = interval_join(
            spark.createDataFrame(points, POINTS), spark.createDataFrame(spans, SPANS), ["key", "other"], "at", "first", "last", stage_points=True
        )
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
        assert sorted((r["p"], r["s"]) for r in joined.collect()) == by_hand(points, spans)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("before, after", [(0, 0), (6, -1), (100, 7), (86_400, 3_600)])
def test_band_join_equals_all_comparisons(spark, before, after):
    pick = random.Random(before)
    points = [(pick.choice(["a", "b"]), pick.randint(0, 400_000), i) for i in range(500)] + [("a", t, 1000 + t) for t in range(40)]
    moments = [(pick.choice(["a", "b"]), pick.randint(0, 400_000), i) for i in range(40)] + [("a", 20, 99)]
    got = band_join(
        spark.createDataFrame(points, "key string, at long, p int"), spark.createDataFrame(moments, "key string, moment long, m int"),
        ["key"], "at", "moment", before, after,
    )
    want = sorted((p, m, at - t) for k, at, p in points for j, t, m in moments if k == j and t - before <= at <= t + after)
    assert sorted((r["p"], r["m"], r["distance"]) for r in got.collect()) == want


def test_one_width_deals_each_point_once(spark):
    points = spark.range(1000).select(F.lit("k").alias("key"), F.col("id").alias("at"))
    moments = spark.range(3).select(F.lit("k").alias("key"), (F.col("id") * 100).alias("moment"))
    plan = band_join(points, moments, ["key"], "at", "moment", 5, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan


def test_micros_do_not_hang_on_the_time_zone(spark):
    day = spark.sql("SELECT TIMESTAMP_NTZ'1969-12-31 23:59:59.5' AS a, TIMESTAMP_NTZ'2024-03-31 02:30:00.000001' AS b")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "Europe/Berlin", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            assert tuple(day.select(micros(F.col("a")), micros(F.col("b"))).first()) == (-500_000, 1711852200000001)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
