import json

import numpy as np
import pytest

from beforeafter.plans.country_study import Study, build, ingest_nested, ingest_wide, land, run
from beforeafter.sinks import published
from beforeafter.sources import read_events
from beforeafter.sources.documents import read_documents

COUNTRIES = ["USA", "ZWE"] + [f"C{chr(65 + i // 26)}{chr(65 + i % 26)}" for i in range(58)]
YEARS = range(1994, 2013)


@pytest.fixture(scope="module")
def study(spark, tmp_path_factory):
    """A small world: 60 countries, two sources, hosts in 2000, 2004 and 2008."""
    rng = np.random.default_rng(1)
    folder = tmp_path_factory.mktemp("landed")
    scale = {c: float(i) for i, c in enumerate(reversed(COUNTRIES))}
    blocks = [
        (c, s, *[float(np.exp(scale.get(c, 9.0) / 10 + k) * (1 + 0.02 * (y - 1994)) + rng.normal()) for y in YEARS])
        for c in COUNTRIES + ["WLD"]
        for k, s in enumerate(["NY.GDP", "SP.POP", "IT.AIR"])
    ]
    wide = spark.createDataFrame(blocks, "economy string, series string, " + ", ".join(f"YR{y} double" for y in YEARS))
    economies = spark.createDataFrame(
        [(c, False, "R", c.title(), "High") for c in COUNTRIES] + [("WLD", True, "", "World", None)],
        "id string, aggregate boolean, region string, value string, incomeLevel string",
    )
    values = {c: {str(y): float(rng.normal() + scale[c] / 20) for y in YEARS} for c in COUNTRIES}
    (folder / "docs").mkdir()
    (folder / "docs" / "lur.json").write_text(json.dumps({"values": {"LUR": values | {"ADVEC": {"2000": 1}}}}))
    (folder / "docs" / "own.json").write_text(json.dumps({"values": {"OWN": values}}))
    (folder / "catalogue.json").write_text(json.dumps({"indicators": {"LUR": {"label": "other"}, "OWN": {"label": "Own's"}}}))
    hosts = "".join(f"{c},{c},{y},no,\n" for y in (2000, 2004, 2008) for c in COUNTRIES[y % 7 :: 9])
    (folder / "hosts.csv").write_text("iso3,country_name,year,co_hosted,notes\n" + hosts)
    imf, labels = ingest_nested(read_documents(spark, str(folder / "docs")), read_documents(spark, str(folder / "catalogue.json")))
    wdi = ingest_wide(wide, economies)
    names = {"entity": "iso3", "indicator": "indicator_code", "time": "year"}
    return Study(
        wdi.withColumnsRenamed(names).cache(),
        imf.withColumnsRenamed(names).cache(),
        read_events(spark, str(folder / "hosts.csv")),
        economies,
        spark.createDataFrame([("NY.GDP", "GDP"), ("SP.POP", "People")], "code string, label string"),
        labels,
    )


def test_ingest(study):
    assert {r.iso3 for r in study.wdi.select("iso3").distinct().collect()} == set(COUNTRIES)
    assert study.wdi.count() == 60 * 3 * 19
    assert study.imf.count() == 60 * 2 * 19


def test_run_publishes_all_tables(spark, study, tmp_path):
    manifest = {r.name: r.n_rows for r in run(spark, study, str(tmp_path)).collect()}
    n_hosts = study.hosts.count()
    assert manifest["fact_host_event_window"] == sum(
        5 * sum(1 for o in range(-6, 7) if r.event_at + o in YEARS) for r in study.hosts.collect()
    )
    assert manifest["training_features"] == n_hosts and manifest["training_features_long"] >= n_hosts and manifest["country_scores"] == 60
    fact = published(spark, str(tmp_path), "fact_host_event_window")
    assert fact.columns == [
        "iso3", "host_year", "event_time", "calendar_year", "indicator_code", "source", "value", "baseline_value", "pct_change",
    ]
    scores = {r.iso3: r for r in published(spark, str(tmp_path), "country_scores").collect()}
    assert all(20 <= r.hosting_readiness_score <= 95 and r.data_completeness == 1.0 for r in scores.values())
    assert scores["USA"].hosting_readiness_score > scores["ZWE"].hosting_readiness_score
    names = {r.indicator_code: (r.indicator_name, r.source) for r in published(spark, str(tmp_path), "dim_indicator").collect()}
    assert names == {
        "NY.GDP": ("GDP", "WDI"),
        "SP.POP": ("People", "WDI"),
        "IT.AIR": ("IT.AIR", "Unknown"),
        "LUR": ("Unemployment Rate (%)", "IMF"),
        "OWN": ("Own's", "IMF"),
    }
    assert manifest["dim_country"] == 61


def test_empty_source_stops_the_run(study):
    with pytest.raises(ValueError, match="IMF"):
        build(Study(study.wdi, study.imf.limit(0), study.hosts, study.economies, study.series_labels))


def test_land_writes_panels_labels_and_faults(spark, tmp_path):
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "a.json").write_text(json.dumps({"values": {"LUR": {"USA": {"2000": 1.5, "2001": "x", "y": 2, "2002": None}}}}))
    (tmp_path / "catalogue.json").write_text(json.dumps({"indicators": {"LUR": {"label": "Unemployed"}}}))
    spark.createDataFrame([("USA", "S", 1.0, None)], "economy string, series string, YR1999 double, YR2000 double").write.parquet(str(tmp_path / "blocks"))
    spark.createDataFrame([("USA", False, "R")], "id string, aggregate boolean, region string").write.parquet(str(tmp_path / "economies"))
    out = land(spark, *(str(tmp_path / n) for n in ("blocks", "docs", "catalogue.json", "economies", "out")))
    assert [tuple(r) for r in out["wdi"].collect()] == [("USA", "S", 1999, 1.0)] and out["wdi"].columns[0] == "iso3"
    assert [r["value"] for r in out["imf"].collect()] == [1.5] and out["imf_labels"].first()[:] == ("LUR", "Unemployed")
    assert out["faults"].first()[:] == (4, 1, 0, 1, 1, 1, 0)
