"""The registered queries: each runs its operators over the supplied tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beforeafter.functions import quoted, time_index
from beforeafter.operators import correlation, dimensions, features, intervals, reports, score, snapshots, windows
from beforeafter.operators.axes import anchored, fit_axes, project
from beforeafter.operators.enclosing import add_distance, fit_ball
from beforeafter.operators.one_class import add_label, fit_boundary
from beforeafter.operators.scaling import scaled_long
from beforeafter.plans.features import dense_features, training_features
from beforeafter.plans.scoring import Prepared, prepare, score_candidates
from beforeafter.plans.supplied import (
    activity_panel,
    cents,
    items_panel,
    nation_events,
    orders_panel,
    raw_activity,
    signup_events,
    table,
    total,
)
from beforeafter.sinks import conform, load, loaded, publish, published, write_sorted
from beforeafter.sinks.bucketed import bucketed_window, write_bucketed
from beforeafter.sinks.retention import clear, rollback
from beforeafter.sources import (
    between_times,
    catalogue_labels,
    event_rejects,
    ingest_report,
    input_report,
    nested_observations,
    profile,
    read_matching,
    require_input,
    resolve_duplicates,
    schema_of,
    three_capitals,
    unify,
    unpivot_times,
    wanted_entities,
)
from beforeafter.sources.large_json import split_documents
from beforeafter.sources.panel import only_entities, read_events
from beforeafter.sources.profiles import STATED_ERROR, refresh_profiles, united_profile
from beforeafter.sources.versions import read_versions
from beforeafter.staging import run_dir, shared_dir, stage

# Features that the null and correlation filters bite on: two months before the event.
FEATURE_MONTHS = 2


def r4(col: Column) -> Column:
    """Four digits, by the arithmetic that the comparison SQL uses too."""
    return F.floor(F.round(col, 8) * 10000 + 0.5) / 10000


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: r4(F.col(n)) for n in names})


def _panel(spark: SparkSession, d: str) -> DataFrame:
    return unify(orders_panel(spark, d), items_panel(spark, d))


# --- sources -----------------------------------------------------------------


def panel_union(spark: SparkSession, d: str) -> DataFrame:
    twice = orders_panel(spark, d).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    return _rounded(resolve_duplicates(unify(twice, items_panel(spark, d)), "any"), "value")


def panel_profile(spark: SparkSession, d: str) -> DataFrame:
    return profile(between_times(_panel(spark, d), 1996 * 12 + 1, 2000 * 12 + 12), by="source")


def profile_from_slices(spark: SparkSession, d: str) -> DataFrame:
    """The profile of activity from weekly slices, stored in two goes and united; whether
    its estimates stay within their stated error of the exact counts."""
    panel = stage(raw_activity(spark, d), "activity")
    root = f"{run_dir(spark)}/profiles-{uuid.uuid4().hex}"
    first_half = panel.agg(((F.min("time") + F.max("time")) / 2).cast("int").alias("t")).first()["t"]
    refresh_profiles(panel.filter(F.col("time") <= F.lit(first_half)), root, by="indicator", width=7)
    united = united_profile(refresh_profiles(panel, root, by="indicator", width=7), by="indicator")
    exact = profile(panel, by="indicator").select("indicator", F.col("n_entities").alias("exact_entities"))
    off = F.abs(F.col("n_entities") - F.col("exact_entities"))
    return united.join(exact, "indicator").select(
        "indicator", "n_rows", "first_time", "last_time", "n_valueless", "exact_entities",
        (off <= F.lit(STATED_ERROR) * F.col("exact_entities")).alias("within_error"),
    )


def unpivot_wide_months(spark: SparkSession, d: str) -> DataFrame:
    wide = (
        stage(orders_panel(spark, d), "orders")
        .groupBy(F.col("entity").alias("economy"), F.col("indicator").alias("series"))
        .pivot("time")
        .agg(F.first("value"))
    )
    return _rounded(unpivot_times(wide), "value")


def json_props_flatten(spark: SparkSession, d: str) -> DataFrame:
    """One nested document per activity row, with the day as time and ``k`` as value."""
    day = time_index(F.col("ts"), "day")
    documents = table(spark, d, "events").select(
        _text(
            '{"values":{"', "event_type", '":{"', "user_id", '":{"', day, '":',
            F.get_json_object("props", "$.k"), '}, "none": 7}}}',
        )
    )
    flat = nested_observations(documents)
    return flat.groupBy("entity", "indicator", "time").agg(
        F.count("value").alias("n"), F.sum("value").alias("total")
    )


def json_large_documents(spark: SparkSession, d: str) -> DataFrame:
    """Activity written as one nested document per thousand users, type → user → day →
    sum of ``k``, and read back from byte ranges."""
    day = time_index(F.col("ts"), "day")
    k = F.get_json_object("props", "$.k").cast("long")
    sums = table(spark, d, "events").groupBy("event_type", "user_id", day.alias("day")).agg(F.sum(k).alias("k"))
    # One object per user: at most as many members as there are days.
    days = F.array_sort(F.collect_list(F.concat(F.lit('"'), F.col("day"), F.lit('":'), F.col("k"))))
    users = sums.groupBy(F.expr("user_id div 1000").alias("doc"), "event_type", "user_id").agg(days.alias("days"))
    line = F.concat(F.lit(',"'), F.col("user_id"), F.lit('":{"a,b":"x}", '), F.array_join("days", ", "), F.lit("}"))
    users = users.select("doc", "event_type", F.lit(1).alias("part"), "user_id", line.alias("line"))
    types = users.select("doc", "event_type").distinct()
    none = F.lit(None).cast("long")
    opened = types.select("doc", "event_type", F.lit(0), none, F.concat(F.lit(',"'), "event_type", F.lit('": {"none": 7')))
    closed = types.select("doc", "event_type", F.lit(2), none, F.lit("}"))
    whole = types.select("doc").distinct()
    head = whole.select("doc", F.lit(""), F.lit(0), none, F.lit('{"note": "a, {b", "values": {"none": [1, 2]'))
    foot = whole.select("doc", F.lit("~"), F.lit(2), none, F.lit("}}"))
    lines = users.union(opened).union(closed).union(head).union(foot)
    path = f"{run_dir(spark)}/large-json-{uuid.uuid4().hex}"
    ordered = lines.repartition("doc").sortWithinPartitions("doc", "event_type", "part", "user_id")
    ordered.select("doc", "line").write.partitionBy("doc").text(path)
    read = nested_observations(split_documents(spark, path, chunk_chars=1 << 16))
    return read.groupBy("entity", "indicator").agg(
        F.count("value").alias("n"), F.sum("value").alias("total"), F.min("time").alias("first"), F.max("time").alias("last")
    )


def json_catalogue_labels(spark: SparkSession, d: str) -> DataFrame:
    """One catalogue per activity row; clicks come without a label."""
    field = F.when(F.col("event_type") != "click", _text('"label":"kind ', "event_type", '"')).otherwise('"unit":"t"')
    documents = table(spark, d, "events").select(
        _text('{"indicators":{"', "event_type", "/", "user_id", '":{', field, "}}}")
    )
    return catalogue_labels(documents, "indicators").groupBy("code", "label").agg(F.count(F.lit(1)).alias("n"))


def _text(*parts: str | Column) -> Column:
    """Texts and columns in a row; a plain name stands for its column."""
    names = ("event_type", "user_id")
    return F.concat(*[F.lit(p) if isinstance(p, str) and p not in names else p for p in parts]).alias("document")


def iso_like_filter(spark: SparkSession, d: str) -> DataFrame:
    tail = F.when(F.col("lang") == "en", F.upper(F.substring("source", 1, 1))).otherwise(F.col("source"))
    codes = table(spark, d, "documents").select(F.concat(F.upper("lang"), tail).alias("code"))
    return codes.filter(three_capitals(F.col("code"))).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def entity_filter_fallback(spark: SparkSession, d: str) -> DataFrame:
    customers = table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        (F.col("c_acctbal") < 2000).alias("aggregate"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.col("c_mktsegment")).alias("region"),
    )
    nations = table(spark, d, "nation").select(
        F.col("n_name").alias("id"), (F.col("n_regionkey") > 0).alias("aggregate"), F.lit("").alias("region")
    )
    buyers = table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("entity"), "o_totalprice")
    bought = (
        only_entities(buyers, wanted_entities(customers, 50))
        .groupBy(F.col("entity").alias("id"))
        .agg(F.count(F.lit(1)).alias("n"), total(F.col("o_totalprice")).alias("spent"))
    )
    none = wanted_entities(nations, 50).select("id", F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("spent"))
    return bought.unionByName(none)


# --- windows -----------------------------------------------------------------


def event_window(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(windows.event_window(_panel(spark, d), nation_events(spark, d)), "value")


def _signups(spark: SparkSession, d: str) -> DataFrame:
    """Derived by a pass over all activity, so done once."""
    return stage(signup_events(spark, d), "signups")


def event_window_users(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(windows.event_window(activity_panel(spark, d), _signups(spark, d)), "value")


def event_window_dense(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(windows.event_window(_panel(spark, d), nation_events(spark, d), how="left"), "value")


def event_window_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """The same on a panel stored by entity and time, which the join does not move."""
    name = f"panel_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    panel = write_bucketed(_panel(spark, d), name, buckets, f"{run_dir(spark)}/{name}")
    return _rounded(bucketed_window(panel, nation_events(spark, d)), "value")


def _change(spark: SparkSession, d: str) -> DataFrame:
    # Both panels are grouped by the panel key, so a series has one row per month.
    return windows.event_window_change(_panel(spark, d), nation_events(spark, d), unique_times=True)


def event_window_change(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_change(spark, d), "value", "baseline_value", "pct_change")


def event_window_change_raw(spark: SparkSession, d: str) -> DataFrame:
    """Any number of rows per user, type and day: the baseline is joined back."""
    changed = windows.event_window_change(raw_activity(spark, d), _signups(spark, d))
    return _rounded(changed, "value", "baseline_value", "pct_change")


def event_window_change_mixed(spark: SparkSession, d: str) -> DataFrame:
    """One baseline over all sources of an indicator."""
    shared = _panel(spark, d).withColumn(
        "indicator", F.when(F.col("source") == "ORD", "SALES").otherwise(F.col("indicator"))
    )
    shared = shared.withColumn("indicator", F.when(F.col("indicator") == "B.Brand#1", "SALES").otherwise(F.col("indicator")))
    changed = windows.event_window_change(
        shared, nation_events(spark, d), baseline_keys=("entity", "event_at", "indicator")
    )
    return _rounded(changed, "value", "baseline_value", "pct_change")


def event_window_sample(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(windows.sample_series(stage(_change(spark, d), "fact")), "value", "baseline_value", "pct_change")


# --- features ----------------------------------------------------------------


def pre_event_mean(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(windows.pre_event_means(_panel(spark, d), nation_events(spark, d)), "avg_value")


def _moments(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", "user_id", "event_type", "value", intervals.micros(F.col("ts")).alias("at"))


def activity_around_purchase(spark: SparkSession, d: str) -> DataFrame:
    """What each user did from a day ahead of a purchase to six hours behind it, to the
    microsecond: rows, value and the nearest moment ahead, by kind."""
    rows = _moments(spark, d)
    bought = rows.filter(F.col("event_type") == "purchase").select("user_id", F.col("event_id").alias("purchase"), F.col("at").alias("bought_at"))
    met = intervals.band_join(rows, bought, ["user_id"], "at", "bought_at", 86_400_000_000, 21_600_000_000)
    return met.groupBy("purchase", "event_type").agg(
        F.count(F.lit(1)).alias("n"),
        total(F.col("value")).alias("total"),
        F.max(F.when(F.col("distance") < 0, F.col("distance"))).alias("nearest_before"),
    )


def activity_between_signups(spark: SparkSession, d: str) -> DataFrame:
    """Activity of each user from one signup until just before the next, however long
    that is; the last one lasts a day."""
    rows = _moments(spark, d)
    signups = rows.filter(F.col("event_type") == "signup").select("user_id", F.col("event_id").alias("signup"), F.col("at").alias("start"))
    following = F.lead("start").over(Window.partitionBy("user_id").orderBy("start", "signup"))
    spans = signups.withColumn("end", F.coalesce(following, F.col("start") + 86_400_000_000) - 1)
    met = intervals.interval_join(rows.filter(F.col("event_type") != "signup"), spans, ["user_id"], "at", "start", "end")
    return met.groupBy("signup").agg(F.count(F.lit(1)).alias("n"), total(F.col("value")).alias("total"), F.max("end").alias("end"))


def _flag_panel(spark: SparkSession, d: str) -> DataFrame:
    return items_panel(spark, d, by_flag=True)


def feature_null_filter(spark: SparkSession, d: str) -> DataFrame:
    kept = dense_features(_flag_panel(spark, d), nation_events(spark, d), FEATURE_MONTHS)
    return _rounded(kept, "avg_value")


def feature_missing_counts(spark: SparkSession, d: str) -> DataFrame:
    means = stage(windows.pre_event_means(_flag_panel(spark, d), nation_events(spark, d), FEATURE_MONTHS), "features")
    return features.missing_counts(means)


def feature_matrix_wide(spark: SparkSession, d: str) -> DataFrame:
    """All codes as columns."""
    means = stage(windows.pre_event_means(_panel(spark, d), nation_events(spark, d)), "means")
    wide = features.wide_matrix(means)
    codes = [c for c in wide.columns if c not in ("entity", "event_at")]
    return wide.select("entity", "event_at", *[r4(quoted(c)).alias(c) for c in codes])


def correlation_pairs(spark: SparkSession, d: str) -> DataFrame:
    kept = dense_features(_flag_panel(spark, d), nation_events(spark, d), FEATURE_MONTHS)
    return _rounded(correlation.correlation_pairs(kept), "r")


def correlation_above(spark: SparkSession, d: str) -> DataFrame:
    """Only the pairs above the threshold, found without working out all of them."""
    kept = dense_features(_flag_panel(spark, d), nation_events(spark, d), FEATURE_MONTHS)
    return _rounded(correlation.correlated_pairs(kept, 0.9).pairs, "r")


def correlation_kept(spark: SparkSession, d: str) -> DataFrame:
    kept = training_features(_flag_panel(spark, d), nation_events(spark, d), FEATURE_MONTHS)
    return _rounded(kept, "avg_value")


# --- snapshots and model -----------------------------------------------------


def snapshot_latest(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(snapshots.snapshot_latest(_panel(spark, d)), "value")


def snapshot_latest_per_source(spark: SparkSession, d: str) -> DataFrame:
    latest = snapshots.snapshot_latest(_panel(spark, d), "per_source", "prefer_source", ["ORD", "LI"])
    return _rounded(latest, "value")


def snapshot_at_event(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(snapshots.snapshot_at_event(_panel(spark, d), nation_events(spark, d)), "value")


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Reference snapshots at the events and candidate snapshots at the end of each
    source, each reduced from the panel by itself: the panel is not written."""
    panel = _panel(spark, d)
    return snapshots.snapshot_at_event(panel, nation_events(spark, d)), snapshots.snapshot_latest(panel, "per_source")


def _prepared(reference: DataFrame, candidates: DataFrame) -> Prepared:
    return prepare(stage(reference, "reference"), stage(candidates, "candidates"))


def common_indicators(spark: SparkSession, d: str) -> DataFrame:
    return features.common_indicators(*[stage(side, "side") for side in _sides(spark, d)])


def signed_log_scaled(spark: SparkSession, d: str) -> DataFrame:
    ready = _prepared(*_sides(spark, d))
    keys = ["entity", "event_at"]
    candidates = ready.candidate_rows.select("entity", F.lit(None).cast("int").alias("event_at"), "z")
    both = scaled_long(ready.reference_rows.select(*keys, "z"), ready.scaling, keys).unionByName(
        scaled_long(candidates, ready.scaling, keys)
    )
    return _rounded(both, "scaled")


def pca_axes(spark: SparkSession, d: str) -> DataFrame:
    ready = _prepared(*_sides(spark, d))
    axes = fit_axes(stage(ready.reference_rows, "reference-rows"))
    cand = project(ready.candidate_rows, axes)
    turned = anchored(cand, cand.select("entity", "axis_1"), "NATION_1", "NATION_2").drop("z")
    return _rounded(turned, "axis_1", "axis_2")


def one_class_score(spark: SparkSession, d: str) -> DataFrame:
    ready = _prepared(*_sides(spark, d))
    boundary = fit_boundary(stage(ready.reference_rows, "reference-rows"))
    return _rounded(add_label(ready.candidate_rows, boundary).drop("z"), "decision")


def one_class_score_features(spark: SparkSession, d: str) -> DataFrame:
    """Many reference rows and more candidates: user and day rows against signup days."""
    panel = activity_panel(spark, d)
    reference = snapshots.snapshot_at_event(panel, _signups(spark, d))
    candidates = panel.select(F.concat_ws("@", "entity", "time").alias("entity"), "indicator", "value")
    ready = _prepared(reference, candidates)
    boundary = fit_boundary(stage(ready.reference_rows, "reference-rows"))
    return _rounded(add_label(ready.candidate_rows, boundary).drop("z"), "decision")


def enclosing_ball(spark: SparkSession, d: str) -> DataFrame:
    """User and day rows against the ball around all signup days: distance and label."""
    panel = activity_panel(spark, d)
    reference = snapshots.snapshot_at_event(panel, _signups(spark, d))
    candidates = panel.select(F.concat_ws("@", "entity", "time").alias("entity"), "indicator", "value")
    ready = _prepared(reference, candidates)
    ball = fit_ball(stage(ready.reference_rows, "reference-rows"), epsilon=1e-11)
    return _rounded(add_distance(ready.candidate_rows, ball).drop("z"), "distance")


def candidate_scores(spark: SparkSession, d: str) -> DataFrame:
    """Everything together: axes, boundary and readiness of every nation."""
    return score_candidates(*_sides(spark, d), anchors=("NATION_1", "NATION_2")).scores


def candidate_scores_sparse(spark: SparkSession, d: str) -> DataFrame:
    """The same on rows of known values alone."""
    return score_candidates(*_sides(spark, d), anchors=("NATION_1", "NATION_2"), sparse=True).scores


def _given_axes(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Two plain axes per customer, and their means per nation as reference."""
    orders = table(spark, d, "orders")
    customers = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    spent = orders.groupBy("o_custkey").agg(F.sum(cents(F.col("o_totalprice"))).alias("c"), F.count(F.lit(1)).alias("n"))
    base = customers.join(spent, customers.c_custkey == spent.o_custkey)
    candidates = base.select(
        F.col("c_custkey").cast("string").alias("entity"),
        (F.col("c") / 1e8).alias("axis_1"),
        (F.col("n") / 10.0).alias("axis_2"),
        F.when(F.col("c_acctbal") < 0, -1).otherwise(1).alias("anomaly_label"),
    )
    reference = base.groupBy("c_nationkey").agg(
        (F.sum("c") / F.count("c") / 1e8).alias("axis_1"), (F.sum("n") / F.count("n") / 10.0).alias("axis_2")
    )
    return candidates, reference


def _given_scores(spark: SparkSession, d: str) -> DataFrame:
    candidates, reference = _given_axes(spark, d)
    return score.add_readiness(candidates, reference)


def readiness_score(spark: SparkSession, d: str) -> DataFrame:
    bought = table(spark, d, "orders").groupBy(
        F.col("o_custkey").cast("string").alias("entity"), F.col("o_orderpriority").alias("indicator")
    )
    long = bought.agg(F.max("o_totalprice").alias("value"))
    kinds = table(spark, d, "orders").select(F.col("o_orderpriority").alias("indicator")).distinct()
    return score.score_rows(_given_scores(spark, d), score.completeness(long, kinds))


def status_report(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("entity"))
    unknown = table(spark, d, "supplier").select(F.col("s_name").alias("entity"))
    return score.evaluate(_given_scores(spark, d), known.unionByName(unknown))


# --- dimensions and reports --------------------------------------------------


def _brand_labels(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(
        F.concat(F.lit("B."), "p_brand").alias("code"), F.concat(F.lit("The '"), "p_brand", F.lit("' mean price")).alias("label")
    )


def _priority_labels(spark: SparkSession, d: str) -> DataFrame:
    return (
        table(spark, d, "orders")
        .filter(F.col("o_orderpriority") < "4")
        .select(F.col("o_orderpriority").alias("code"), F.concat(F.lit("Orders "), "o_orderpriority").alias("label"))
    )


def dim_indicator(spark: SparkSession, d: str) -> DataFrame:
    fact = windows.event_window(_panel(spark, d), nation_events(spark, d))
    ladder = [
        (_brand_labels(spark, d), "LI"),
        (dimensions.known_names(spark).unionByName(_priority_labels(spark, d)), "ORD"),
    ]
    return dimensions.dim_indicator(fact, ladder)


def dim_entity(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.dim_entity(_customer_catalogue(spark, d))


def _customer_catalogue(spark: SparkSession, d: str) -> DataFrame:
    customers = table(spark, d, "customer")
    nations = table(spark, d, "nation")
    regions = table(spark, d, "region").filter(F.col("r_name") != "ASIA")
    return (
        customers.join(nations, customers.c_nationkey == nations.n_nationkey)
        .join(regions, nations.n_regionkey == regions.r_regionkey, "left")
        .select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("value"),
            F.col("r_name").alias("region"),
            F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("incomeLevel"),
        )
    )


def score_by_region(spark: SparkSession, d: str) -> DataFrame:
    scores = _given_scores(spark, d).select("entity", "anomaly_label", r4(F.col("readiness")).alias("readiness_score"))
    entities = dimensions.dim_entity(_customer_catalogue(spark, d))
    return reports.score_by_region(scores, entities, ["AFRICA", "EUROPE", ""])


def top_ranked(spark: SparkSession, d: str) -> DataFrame:
    scores = _given_scores(spark, d).select("entity", r4(F.col("raw_score")).alias("readiness_score"))
    return reports.top_ranked(scores, 25)


def indicator_over_event_time(spark: SparkSession, d: str) -> DataFrame:
    labels = _priority_labels(spark, d)
    shown = reports.over_event_time(
        _change(spark, d),
        dimensions.dim_indicator(labels.select(F.col("code").alias("indicator")), [(labels, "ORD")]),
        ["1-URGENT", "5-LOW", "B.Brand#7"],
    )
    return _rounded(shown, "value", "baseline_value", "pct_change")


def entity_over_event_time(spark: SparkSession, d: str) -> DataFrame:
    """The drill-down: all series of two entities over event time."""
    names = [(_priority_labels(spark, d), "ORD"), (_brand_labels(spark, d), "LI")]
    codes = names[0][0].unionByName(names[1][0]).select(F.col("code").alias("indicator"))
    shown = reports.over_event_time(_change(spark, d), dimensions.dim_indicator(codes, names), entities=["NATION_3", "NATION_11"])
    return _rounded(shown, "value", "baseline_value", "pct_change")


def events_from_csv(spark: SparkSession, d: str) -> DataFrame:
    """Events landed as CSV with their columns in another order, read by header: pre-event
    means of the nations that they name. Repeated and unreadable rows are no events."""
    nations = table(spark, d, "nation")
    year = F.when(F.col("n_regionkey") == 2, "soon").otherwise((F.lit(1998 * 12) + F.col("n_nationkey")).cast("string"))
    landed = nations.select(
        F.concat(F.lit('host, "'), F.lower("n_name"), F.lit('"')).alias("notes"), year.alias("month"), F.lit("no").alias("co_hosted"), F.col("n_name").alias("economy")
    )
    path = f"{run_dir(spark)}/events-csv-{uuid.uuid4().hex}"
    landed.union(landed.filter(F.col("economy") < "K")).write.option("header", True).option("escape", '"').csv(path)
    means = windows.pre_event_means(_panel(spark, d), read_events(spark, path, "economy", "month"))
    return _rounded(means, "avg_value")


# --- sinks -------------------------------------------------------------------

_ORDER_TARGET = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("lines", T.IntegerType()),
        T.StructField("note", T.StringType()),
    ]
)


def _landed_orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders as text, with prices of one priority unreadable and one column in another case."""
    return table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("ORDER_ID"),
        F.when(F.col("o_orderpriority") == "5-LOW", "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("Price"),
        F.when(F.col("o_orderstatus") == "F", "many").otherwise("3").alias("lines"),
        F.col("o_orderstatus").alias("status"),
    )


def conform_rows(spark: SparkSession, d: str) -> DataFrame:
    return conform(_landed_orders(spark, d), _ORDER_TARGET).good


def rejected_rows(spark: SparkSession, d: str) -> DataFrame:
    rejected = conform(_landed_orders(spark, d), _ORDER_TARGET).rejected
    return rejected.select(
        F.col("ORDER_ID").alias("order_id"),
        F.col("lines"),
        "status",
        F.array_join("rejected", ",").alias("rejected"),
    )


def load_report(spark: SparkSession, d: str) -> DataFrame:
    root = f"{run_dir(spark)}/loaded-orders"
    report = load(_landed_orders(spark, d), _ORDER_TARGET, root)
    back = loaded(spark, root, _ORDER_TARGET).agg(F.count(F.lit(1)).alias("n_read"))
    return report.select(
        "n_loaded",
        "n_rejected",
        F.array_join("missing", ",").alias("missing"),
        F.array_join("extra", ",").alias("extra"),
        back.scalar().alias("n_read"),
    )


def ingest_faults(spark: SparkSession, d: str) -> DataFrame:
    """Every landed order accounted for, its line count read as the time."""
    return ingest_report(_landed_orders(spark, d), "ORDER_ID", "status", "lines", "price")


def event_fault_rows(spark: SparkSession, d: str) -> DataFrame:
    """Landed orders that are no events, by reason."""
    rejects = event_rejects(_landed_orders(spark, d), "ORDER_ID", "lines")
    return rejects.groupBy("rejected").agg(F.count(F.lit(1)).alias("n_rows"))


def fact_in_file_order(spark: SparkSession, d: str) -> DataFrame:
    """The fact written in folders by source and in key order: rows, and rows that lie
    behind a greater key of their file."""
    keys = ["entity", "event_at", "indicator", "offset"]
    path = f"{run_dir(spark)}/sorted-fact"
    write_sorted(_change(spark, d), path, keys, ["source"])
    back = spark.read.parquet(path).select(
        F.input_file_name().alias("file"), F.struct(*keys).alias("key"), F.monotonically_increasing_id().alias("at")
    )
    before = F.lag("key").over(Window.partitionBy("file").orderBy("at"))
    return back.select((before > F.col("key")).alias("behind")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("behind").alias("n_behind")
    )


def infer_schema(spark: SparkSession, d: str) -> DataFrame:
    path = f"{d}/lineitem.parquet"
    found = read_matching(spark, path, glob="*.parquet", regex="lineitem")
    counts = input_report(found, found.schema, "lineitem").select("name", "n_rows", "n_values")
    return schema_of(spark, path).join(counts, "name")


def orders_of_versions(spark: SparkSession, d: str) -> DataFrame:
    """Orders written by three versions of a job: whole prices, then cents, priorities and
    days, then moments and a name in capitals. Read as one table."""
    orders = table(spark, d, "orders")
    path = f"{run_dir(spark)}/versions-{uuid.uuid4().hex}"
    key, price, day = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderdate")
    written = {
        "F": [key.cast("int").alias("id"), F.floor(price).cast("int").alias("price"), "o_orderstatus"],
        "O": [key.alias("id"), price.alias("price"), "o_orderstatus", "o_orderpriority", day.cast("date").alias("placed")],
        "P": [key.alias("ID"), price.alias("PRICE"), "o_orderstatus", day.alias("placed")],
    }
    for status, columns in written.items():
        orders.filter(F.col("o_orderstatus") == status).select(*columns).write.parquet(f"{path}/version={status}")
    return read_versions(spark, path).groupBy("o_orderstatus").agg(
        F.count("id").alias("n"),
        total(F.col("price")).alias("total"),
        F.count("o_orderpriority").alias("n_priorities"),
        F.date_format(F.max("placed"), "yyyy-MM-dd HH:mm:ss").alias("last_placed"),
        F.concat_ws(",", F.typeof(F.any_value("id")), F.typeof(F.any_value("price")), F.typeof(F.any_value("placed"))).alias("types"),
    )


def input_report_orders(spark: SparkSession, d: str) -> DataFrame:
    wanted = T.StructType(
        [
            T.StructField("O_ORDERKEY", T.LongType()),
            T.StructField("o_totalprice", T.DoubleType()),
            T.StructField("o_orderpriority", T.StringType()),
        ]
    )
    return require_input(table(spark, d, "orders"), wanted, "orders")


def publish_manifest(spark: SparkSession, d: str) -> DataFrame:
    scores = _given_scores(spark, d).select("entity", "anomaly_label", "readiness")
    entities = dimensions.dim_entity(_customer_catalogue(spark, d))
    root = f"{shared_dir(spark)}/beforeafter/published"
    manifest = publish(spark, root, {"fact": _change(spark, d), "scores": scores, "entities": entities}, ["fact"])
    return manifest.select("name", "n_rows")


def published_after_rollback(spark: SparkSession, d: str) -> DataFrame:
    """Four runs published, the last taken back and the oldest ones cleared: what is live,
    and how many runs still have files."""
    scores = stage(_given_scores(spark, d).select("entity", "readiness"), "scores")
    root = f"{run_dir(spark)}/published-{uuid.uuid4().hex}"
    for limit in (20, 40, 60, 80):
        publish(spark, root, {"scores": scores.filter(F.col("readiness") < limit), "all": scores})
    manifest = rollback(spark, root)
    cleared = clear(spark, root, keep=2)
    low = published(spark, root, "scores").agg(F.count(F.lit(1)).alias("n_live"), F.max("readiness").alias("highest"))
    n_cleared = cleared.count()
    return low.select(
        F.lit(manifest.agg(F.sum("n_rows")).first()[0]).alias("n_rows"), F.lit(n_cleared).cast("long").alias("n_cleared"), "n_live",
        r4(F.col("highest")).alias("highest"),
    )


QUERIES = {
    q.__name__: q
    for q in (
        panel_union,
        panel_profile,
        profile_from_slices,
        unpivot_wide_months,
        json_props_flatten,
        json_large_documents,
        json_catalogue_labels,
        iso_like_filter,
        entity_filter_fallback,
        event_window,
        event_window_bucketed,
        event_window_users,
        event_window_dense,
        event_window_change,
        event_window_change_raw,
        event_window_change_mixed,
        event_window_sample,
        pre_event_mean,
        events_from_csv,
        activity_around_purchase,
        activity_between_signups,
        feature_missing_counts,
        feature_null_filter,
        feature_matrix_wide,
        correlation_pairs,
        correlation_above,
        correlation_kept,
        snapshot_latest,
        snapshot_latest_per_source,
        snapshot_at_event,
        common_indicators,
        signed_log_scaled,
        pca_axes,
        one_class_score,
        one_class_score_features,
        enclosing_ball,
        candidate_scores,
        candidate_scores_sparse,
        readiness_score,
        status_report,
        dim_indicator,
        dim_entity,
        score_by_region,
        top_ranked,
        indicator_over_event_time,
        entity_over_event_time,
        conform_rows,
        rejected_rows,
        load_report,
        ingest_faults,
        event_fault_rows,
        fact_in_file_order,
        infer_schema,
        orders_of_versions,
        input_report_orders,
        publish_manifest,
        published_after_rollback,
    )
}
