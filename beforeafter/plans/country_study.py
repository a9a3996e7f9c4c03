"""The whole study over country-year indicators: ingest, build, score, publish.

Published tables carry the column names of the country study; everything between
works on the generic ones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beforeafter.operators.dimensions import dim_entity, dim_indicator, known_names
from beforeafter.operators.features import wide_matrix
from beforeafter.operators.snapshots import snapshot_at_event, snapshot_latest
from beforeafter.operators.windows import event_window_change
from beforeafter.plans.features import training_features
from beforeafter.plans.scoring import score_candidates
from beforeafter.schema import EVENT_KEYS, OBSERVATIONS, SERIES_KEYS
from beforeafter.sinks.publish import Layout, publish
from beforeafter.sources import (
    between_times,
    catalogue_labels,
    ingest_report,
    nested_observations,
    observations,
    require_input,
    tag_source,
    three_capitals,
    unify,
    unpivot_times,
    wanted_entities,
)
from beforeafter.sources.documents import nested_entries, read_documents
from beforeafter.sources.panel import only_entities
from beforeafter.staging import stage

# Years of the wide source, and the countries that pin the first axis.
YEARS = (1960, 2024)
ANCHORS = ("USA", "ZWE")
# Fixed value: fewer real economies mean that the catalogue's marks are wrong.
MINIMUM_ECONOMIES = 50

PANEL_NAMES = {"entity": "iso3", "indicator": "indicator_code", "time": "year"}
FACT_NAMES = {
    "entity": "iso3",
    "event_at": "host_year",
    "offset": "event_time",
    "time": "calendar_year",
    "indicator": "indicator_code",
}
FEATURE_NAMES = {"entity": "host_iso3", "event_at": "tournament_year"}
SCORE_NAMES = {"entity": "iso3", "readiness_score": "hosting_readiness_score"}
COUNTRY_NAMES = {"entity": "iso3", "name": "country_name"}
INDICATOR_NAMES = {"indicator": "indicator_code", "name": "indicator_name"}


def ingest_wide(blocks: DataFrame, economies: DataFrame, years: tuple[int, int] = YEARS) -> DataFrame:
    """Wide blocks (``economy, series`` and one column per year) → observations of real
    economies (``id, aggregate, region``) in the given years."""
    long = between_times(unpivot_times(blocks), *years)
    return only_entities(long, wanted_entities(economies, MINIMUM_ECONOMIES)).select("entity", "indicator", "time", "value")


def ingest_nested(documents: DataFrame, catalogue: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nested JSON documents → observations of country codes; catalogue → labels."""
    values = nested_observations(documents).filter(three_capitals(F.col("entity")))
    return values.dropna(subset=["value"]), catalogue_labels(catalogue, "indicators")


@dataclass(frozen=True)
class Study:
    """Landed inputs. ``wdi`` and ``imf`` have ``iso3, indicator_code, year, value``."""

    wdi: DataFrame
    imf: DataFrame
    hosts: DataFrame
    economies: DataFrame
    series_labels: DataFrame
    imf_labels: DataFrame | None = None
    latest: str | int = "global"
    duplicates: str = "error"
    source_order: Sequence[str] = ("WDI", "IMF")
    baseline_keys: Sequence[str] = SERIES_KEYS
    before: int = 6
    window: tuple[int, int] = (-6, 6)
    anchors: tuple[str, str] = ANCHORS
    boundary: Mapping[str, object] = field(default_factory=dict)
    wide: bool = True

    def panel(self) -> DataFrame:
        sides = []
        for frame, source in ((self.wdi, "WDI"), (self.imf, "IMF")):
            side = observations(frame)
            require_input(side, OBSERVATIONS, source)
            sides.append(tag_source(side, source))
        return unify(*sides)


def build(study: Study) -> dict[str, DataFrame]:
    """All published tables by name.

    The panel is not written again: each table reads the landed files with its own
    filter on time. The features come as one row per event and indicator, whatever
    their number, and with ``wide`` as a matrix too.
    """
    spark = study.wdi.sparkSession
    panel = study.panel()
    first, last = study.window
    fact = event_window_change(panel, study.hosts, first, last, baseline_keys=study.baseline_keys)
    features = training_features(panel, study.hosts, study.before)
    reference = snapshot_at_event(panel, study.hosts, study.duplicates, study.source_order)
    candidates = snapshot_latest(panel, study.latest, study.duplicates, study.source_order)
    scored = score_candidates(reference, candidates, study.anchors, **study.boundary)
    names = known_names(spark)
    if study.imf_labels is not None:
        named = study.imf_labels.join(names.select("code"), "code", "left_anti")
        names = names.unionByName(named)
    fact, kept = stage(fact, "fact"), stage(features, "kept")
    indicators = dim_indicator(fact, [(study.series_labels, "WDI"), (names, "IMF")])
    matrix = {"training_features": wide_matrix(kept, keys=EVENT_KEYS).withColumnsRenamed(FEATURE_NAMES)} if study.wide else {}
    return matrix | {
        "fact_host_event_window": fact.withColumnsRenamed(FACT_NAMES),
        "training_features_long": kept.withColumnsRenamed(FEATURE_NAMES),
        "country_scores": scored.scores.withColumnsRenamed(SCORE_NAMES),
        "dim_indicator": indicators.withColumnsRenamed(INDICATOR_NAMES),
        "dim_country": dim_entity(study.economies).withColumnsRenamed(COUNTRY_NAMES),
    }


def run(spark: SparkSession, study: Study, root: str) -> DataFrame:
    """Build everything and publish it as one run; returns the manifest."""
    order = Layout(["source"], ["iso3", "host_year", "indicator_code", "event_time"])
    return publish(
        spark, root, build(study), ["fact_host_event_window", "country_scores"], {"fact_host_event_window": order}
    )


def land(
    spark: SparkSession, blocks: str, documents: str, catalogue: str, economies: str, out: str
) -> dict[str, DataFrame]:
    """Ingest from paths and write what the study reads: ``wdi``, ``imf`` and
    ``imf_labels`` under ``out``, with the panels' column names, and ``faults``, which
    accounts for the nested values that did not fit.

    ``blocks`` and ``economies`` are Parquet, ``documents`` and ``catalogue`` JSON.
    """
    imf_documents = read_documents(spark, documents)
    imf, labels = ingest_nested(imf_documents, read_documents(spark, catalogue))
    wdi = ingest_wide(spark.read.parquet(blocks), spark.read.parquet(economies))
    faults = ingest_report(nested_entries(imf_documents), "entity", "indicator", "time", "value")
    tables = {
        "wdi": wdi.withColumnsRenamed(PANEL_NAMES),
        "imf": imf.withColumnsRenamed(PANEL_NAMES),
        "imf_labels": labels,
        "faults": faults,
    }
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{out}/{name}")
    return {name: spark.read.parquet(f"{out}/{name}") for name in tables}
