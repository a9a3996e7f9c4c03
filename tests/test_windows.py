import random

import pytest
from pyspark.sql import functions as F

from beforeafter.operators.windows import (
    add_baseline,
    event_skeleton,
    event_window,
    event_window_change,
    pre_event_means,
    sample_series,
)
from beforeafter.schema import FACT_COLUMNS

PANEL = "source string, entity string, indicator string, time int, value double"
EVENTS = "entity string, event_at int"


@pytest.fixture(scope="module")
def panel(spark):
    rows = [("S", "A", "x", t, float(t)) for t in range(90, 111)] + [("S", "B", "x", t, 5.0) for t in (93, 107)]
    return spark.createDataFrame(rows, PANEL).cache()


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame([("A", 100), ("A", 100), ("B", 100), ("C", 100)], EVENTS)


def test_skeleton_is_unique(events):
    assert event_skeleton(events, -6, 6).count() == 3 * 13


def test_window_bounds(panel, events, rows):
    out = event_window(panel, events)
    assert [r[0] for r in rows(out, "time")] == sorted(range(94, 107), key=repr)
    assert {r.entity for r in out.collect()} == {"A"}  # B at -7 and +7 only, C has no data


def test_left_fills_offsets_of_seen_series(spark, events, rows):
    panel = spark.createDataFrame([("S", "B", "x", 99, 1.0), ("S", "B", "x", 100, None)], PANEL)
    out = event_window(panel, events, -2, 1, how="left")
    assert rows(out, "offset", "time", "value") == [(-1, 99, 1.0), (-2, 98, None), (0, 100, None), (1, 101, None)]
    with pytest.raises(ValueError):
        event_window(panel, events, how="outer")


def test_event_span_prunes_the_panel_scan(spark, events, tmp_path):
    path = str(tmp_path / "panel")
    spark.createDataFrame([("S", "A", "x", t, 1.0) for t in range(50)], PANEL).write.parquet(path)
    plan = event_window(spark.read.parquet(path), events)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(time,94)" in plan and "LessThanOrEqual(time,106)" in plan
    assert "BroadcastHashJoin" in plan
    none = event_window(spark.read.parquet(path), events.limit(0))
    assert none.count() == 0


def test_change_against_baseline(panel, events):
    out = event_window_change(panel, events)
    assert tuple(out.columns) == FACT_COLUMNS
    got = {r.offset: r for r in out.collect()}
    assert got[0].baseline_value == 98.0
    assert got[6].pct_change == pytest.approx((106 - 98) / 98 * 100)
    assert sum(got[o].pct_change for o in (-3, -2, -1)) == pytest.approx(0)


@pytest.mark.parametrize("unique_times", [True, False])
@pytest.mark.parametrize(
    "values, baseline, change",
    [
        ({0: 3.0}, None, None),
        ({-1: 0.0, 0: 3.0}, 0.0, None),
        ({-1: -2.0, 0: 3.0}, -2.0, 250.0),
        ({-3: None, -2: 4.0, 0: 3.0}, 4.0, -25.0),
        ({-2: 4.0, 0: None}, 4.0, None),
    ],
)
def test_baseline_edges(spark, unique_times, values, baseline, change):
    panel = spark.createDataFrame([("S", "A", "x", 100 + o, v) for o, v in values.items()], PANEL)
    out = event_window_change(panel, spark.createDataFrame([("A", 100)], EVENTS), unique_times=unique_times)
    row = out.filter("offset = 0").first()
    assert (row.baseline_value, row.pct_change) == (baseline, change)


def test_baseline_by_source_or_mixed(spark):
    panel = spark.createDataFrame([("S", "A", "x", 99, 1.0), ("T", "A", "x", 99, 3.0), ("S", "A", "x", 100, 1.0)], PANEL)
    events = spark.createDataFrame([("A", 100)], EVENTS)
    assert event_window_change(panel, events).filter("offset = 0").first().baseline_value == 1.0
    mixed = event_window_change(panel, events, baseline_keys=("entity", "event_at", "indicator"))
    assert mixed.filter("offset = 0").first().baseline_value == 2.0


def test_event_order_does_not_matter(spark, panel, rows):
    pairs = [("A", t) for t in range(95, 106)]
    shuffled = random.Random(3).sample(pairs, len(pairs))
    a = event_window_change(panel, spark.createDataFrame(pairs, EVENTS))
    b = event_window_change(panel, spark.createDataFrame(shuffled, EVENTS))
    assert rows(a) == rows(b)


def test_both_baseline_ways_agree(panel, spark, rows):
    fact = event_window(panel, spark.createDataFrame([("A", 97), ("A", 103)], EVENTS))
    columns = ("event_at", "offset", "baseline_value")
    assert rows(add_baseline(fact, unique_times=True), *columns) == rows(add_baseline(fact), *columns)


def test_sample_takes_the_smallest_key(panel, spark):
    fact = event_window_change(panel, spark.createDataFrame([("A", 103), ("A", 97), ("B", 100)], EVENTS))
    got = sample_series(fact).collect()
    assert [r.event_at for r in got] == [97] * 13 and [r.offset for r in got] == list(range(-6, 7))
    assert sample_series(fact, event_at=103).first().event_at == 103
    assert sample_series(fact, entity="nobody").count() == 0


def test_pre_event_means(spark, rows):
    panel = spark.createDataFrame(
        [("S", "A", "x", 93, 100.0), ("S", "A", "x", 94, 1.0), ("T", "A", "x", 99, 3.0), ("S", "A", "x", 100, 100.0)]
        + [("S", "A", "y", 95, None)],
        PANEL,
    )
    events = spark.createDataFrame([("A", 100), ("A", 101)], EVENTS)
    assert rows(pre_event_means(panel, events)) == [
        ("A", 100, "x", 2.0, 2),
        ("A", 100, "y", None, 0),
        ("A", 101, "x", 51.5, 2),
        ("A", 101, "y", None, 0),
    ]


def test_large_event_side_is_not_broadcast_and_hot_series_is_split(spark, monkeypatch, rows):
    """A third of all rows are copies of one key: the joins split them, no window gathers them."""
    import beforeafter.operators.windows as w

    monkeypatch.setattr(w, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(w, "stage_side", w.stage)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        spread = spark.range(0, 60_000, 1, 16).select(
            F.lit("S").alias("source"),
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("e"), F.col("id") % 500)).alias("entity"),
            F.lit("x").alias("indicator"),
            F.when(F.col("id") % 3 == 0, 99).otherwise(90 + F.col("id") % 20).cast("int").alias("time"),
            F.rand(1).alias("value"),
        )
        events = spark.range(500).select(F.concat(F.lit("e"), F.col("id")).alias("entity"), F.lit(100).alias("event_at"))
        events = events.unionByName(spark.createDataFrame([("hot", 100)], EVENTS))
        out = event_window_change(spread, events)
        assert out.filter("entity = 'hot'").count() == 20_000
        got = out.groupBy().agg(F.count("*").alias("n"), F.sum("pct_change").alias("s"))
        out.write.format("noop").mode("overwrite").save()
        collected = out.collect()
        assert got.first()["n"] == len(collected)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan and "Window" not in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
