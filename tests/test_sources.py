import math

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from beforeafter.schema import OBSERVATIONS
from beforeafter.sources import (
    EmptyInput,
    catalogue_labels,
    event_rejects,
    ingest_report,
    input_report,
    nested_observations,
    observations,
    profile,
    read_events,
    read_events_text,
    read_matching,
    require_input,
    resolve_duplicates,
    schema_of,
    tag_source,
    three_capitals,
    unify,
    unpivot_times,
    wanted_entities,
)
from beforeafter.sources.documents import read_documents
from beforeafter.sources.panel import between_times

PANEL = "source string, entity string, indicator string, time int, value double"


def test_observations_turn_nan_and_infinity_into_null(spark, rows):
    df = spark.createDataFrame(
        [("USA", "A", "2000", "1.5"), ("USA", "A", "2001", "NaN"), ("USA", "A", "2002", "-Infinity"), ("USA", "A", "x", "?")],
        "iso3 string, indicator_code string, year string, value string",
    )
    out = observations(df)
    assert rows(out) == [
        ("USA", "A", 2000, 1.5),
        ("USA", "A", 2001, None),
        ("USA", "A", 2002, None),
        ("USA", "A", None, None),
    ]


def test_literal_rows_keep_the_fixed_schema(spark):
    df = spark.createDataFrame([("USA", "A", 2000, None)], OBSERVATIONS)
    assert df.schema == OBSERVATIONS


def test_unify_keeps_copies_and_fills_missing_columns(spark, rows):
    a = tag_source(spark.createDataFrame([("e", "i", 1, 1.0)] * 2, "entity string, indicator string, time int, value double"), "A")
    b = spark.createDataFrame([("e", "i", 1)], "entity string, indicator string, time int")
    assert rows(unify(a, b)) == [("A", "e", "i", 1, 1.0), ("A", "e", "i", 1, 1.0), (None, "e", "i", 1, None)]


def test_duplicate_policies(spark, rows):
    panel = spark.createDataFrame(
        [("IMF", "e", "i", 1, 4.0), ("WDI", "e", "i", 1, 2.0), ("WDI", "e", "j", 1, None), ("IMF", "e", "j", 1, 7.0)], PANEL
    )
    keys = ["entity", "indicator", "time"]
    assert rows(resolve_duplicates(panel, "mean", keys), "indicator", "value") == [("i", 3.0), ("j", 7.0)]
    preferred = resolve_duplicates(panel, "prefer_source", keys, ["WDI"])
    assert rows(preferred, "indicator", "value", "source") == [("i", 2.0, "WDI"), ("j", 7.0, "IMF")]
    assert resolve_duplicates(panel, "error").count() == 4
    with pytest.raises(SparkRuntimeException, match="repeated key: e, i, 1"):
        resolve_duplicates(panel.filter("indicator = 'i'"), "error", keys).collect()
    with pytest.raises(ValueError):
        resolve_duplicates(panel, "first")


def test_unpivot_picks_time_columns_by_name(spark, rows):
    wide = spark.createDataFrame(
        [("USA", "S", 1.0, None, "note"), ("FRA", "S", None, None, "note")],
        "economy string, series string, YR1999 double, `2000` double, remark string",
    )
    assert rows(unpivot_times(wide)) == [("USA", "S", 1999, 1.0)]
    with pytest.raises(ValueError):
        unpivot_times(wide.select("economy", "series"))


def test_nested_documents_skip_what_does_not_fit(spark, rows, tmp_path):
    good = """{"values": {"A": {"USA": {"1999": 1.5, " 2020 ": "2.5", "year": 3, "2001": null, "2002": "NaN", "2003": "x"},
        "ADVEC": {"2000": 9}, "BAD": 5, "ARR": [{"2000": 1}]}, "B": {}, "C": 7}}"""
    (tmp_path / "a.json").write_text(good)
    (tmp_path / "b.json").write_text('{"values": {}}')
    (tmp_path / "c.json").write_text("no json")
    out = nested_observations(read_documents(spark, str(tmp_path))).dropna(subset=["value"])
    assert rows(out, "entity", "indicator", "time", "value") == [
        ("ADVEC", "A", 2000, 9.0),
        ("USA", "A", 1999, 1.5),
        ("USA", "A", 2020, 2.5),
    ]
    assert rows(out.filter(three_capitals(F.col("entity"))), "entity") == [("USA",), ("USA",)]


def test_catalogue_label_defaults_to_code(spark, rows):
    df = spark.createDataFrame([('{"indicators": {"A": {"label": "Apples"}, "B": {"unit": "t"}, "C": null}}',)], "document string")
    assert rows(catalogue_labels(df, "indicators")) == [("A", "Apples"), ("B", "B"), ("C", "C")]


def test_three_capitals_wants_the_whole_text(spark):
    df = spark.createDataFrame([("USA",), ("EUR",), ("usa",), ("ADVEC",), ("US1",), ("USA\n",), (None,)], "c string")
    assert [r.c for r in df.filter(three_capitals(F.col("c"))).collect()] == ["USA", "EUR"]


@pytest.mark.parametrize("survivors, kept", [(49, 60), (50, 50)])
def test_entity_filter_falls_back_below_fifty(spark, survivors, kept):
    rows = [(f"r{i}", False, None) for i in range(survivors - 1)] + [("agg", True, "Europe")]
    rows += [(f"a{i}", True, "" if i % 2 else None) for i in range(60 - survivors)]
    df = spark.createDataFrame(rows, "id string, aggregate boolean, region string")
    out = wanted_entities(df, 50).collect()
    assert len(out) == kept and {r["fallback"] for r in out} == {survivors < 50}
    assert wanted_entities(df).count() == survivors


def test_events_from_csv_are_unique(spark, rows, tmp_path):
    path = tmp_path / "events.csv"
    path.write_text("iso3,country_name,year,co_hosted,notes\nKOR,Korea,2002,yes,with JPN\nJPN,Japan,2002,yes,\nKOR,Korea,2002,yes,again\n")
    assert rows(read_events(spark, str(path))) == [("JPN", 2002), ("KOR", 2002)]


def test_events_are_found_by_header_and_rejects_told(spark, rows, tmp_path):
    path = tmp_path / "events.csv"
    path.write_text("notes,year,iso3\n,2002,KOR\n,'06,DEU\n,,FRA\n,2010,\nx,2002,KOR\n")
    assert rows(read_events(spark, str(path))) == [("KOR", 2002)]
    text = read_events_text(spark, str(path))
    assert rows(event_rejects(text, "iso3", "year"), "iso3", "rejected") == [("DEU", "bad time"), ("FRA", "no time"), (None, "no entity")]
    other = tmp_path / "other.csv"
    other.write_text("place,host_year\nBRA,2014\n")
    assert rows(read_events(spark, str(other), "place", "host_year")) == [("BRA", 2014)]
    with pytest.raises(ValueError, match="no column iso3, year"):
        read_events(spark, str(other))


def test_files_with_unlike_headers_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("iso3,year\n" + "KOR,2002\n" * 3)
    (tmp_path / "b.csv").write_text("year,iso3\n2006,DEU\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_events(spark, str(tmp_path)).collect()


def test_every_landed_row_is_accounted_for(spark):
    df = spark.createDataFrame(
        [("USA", "A", "2000", "1"), (None, "A", "2000", "1"), ("USA", "A", "x", "1"), ("USA", "A", "2000", None), ("USA", "A", "2000", "?"), ("USA", "A", "2000", "NaN"), ("USA", "A", "2000", "-Infinity")],
        "iso3 string, indicator_code string, year string, value string",
    )
    assert ingest_report(df).first()[:] == (7, 1, 1, 1, 1, 1, 2)


def test_profile_counts(spark):
    panel = spark.createDataFrame([("A", "e", "i", 3, 1.0), ("A", "f", "i", 5, None), ("B", "e", "j", 4, 1.0)], PANEL)
    assert profile(panel).first().asDict() == {
        "n_rows": 3, "n_indicators": 2, "n_entities": 2, "first_time": 3, "last_time": 5, "n_valueless": 1,
    }
    assert profile(panel, "source", approximate=True).count() == 2


def test_time_range_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([("A", "e", "i", t, 1.0) for t in range(9)], PANEL).write.parquet(path)
    df = between_times(spark.read.parquet(path), 2, 4).select("time")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(time,2)" in plan and "ReadSchema: struct<time:int>" in plan
    assert df.count() == 3


def test_files_picked_by_pattern(spark, tmp_path):
    for name, n in (("country_scores", 2), ("other", 5)):
        spark.range(n).coalesce(1).write.parquet(str(tmp_path / name))
    assert read_matching(spark, str(tmp_path), glob="*.parquet").count() == 7
    assert read_matching(spark, str(tmp_path), regex=".*country_scores.*").count() == 2
    assert [r["type"] for r in schema_of(spark, str(tmp_path / "other")).collect()] == ["bigint"]


def test_input_check(spark):
    df = spark.createDataFrame([("USA", "A", 2000, None)], OBSERVATIONS)
    report = require_input(df, OBSERVATIONS).collect()
    assert [(r.name, r.n_values) for r in report] == [("entity", 1), ("indicator", 1), ("time", 1), ("value", 0)]
    assert all(r.present and r.type_ok for r in report)
    with pytest.raises(EmptyInput):
        require_input(df.limit(0), OBSERVATIONS)
    with pytest.raises(EmptyInput, match="value"):
        require_input(df.drop("value"), OBSERVATIONS)
    assert math.isclose(sum(r.present for r in input_report(df.drop("time"), OBSERVATIONS).collect()), 3)
