import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beforeafter.operators.dimensions import KNOWN_NAMES, dim_entity, dim_indicator, known_names
from beforeafter.operators.reports import over_event_time, score_by_region, top_ranked
from beforeafter.sinks import Layout, conform, load, load_rejects, loaded, publish, published, write_sorted
from beforeafter.sinks.publish import PublishFailed, live_run
from beforeafter.staging import broadcast_if_small, measured_bytes, stage, stage_side

TARGET = T.StructType(
    [
        T.StructField("iso3", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("note", T.StringType()),
    ]
)


def test_conform_lists_missing_and_extra(spark, rows):
    df = spark.createDataFrame([("USA", "2000", "1.5", 1), ("FRA", "x", "2", 2), ("DEU", None, "z", 3)], "ISO3 string, Year string, score string, more int")
    out = conform(df, TARGET)
    assert out.missing == ["note"] and out.extra == ["more"]
    assert out.good.schema == TARGET
    assert rows(out.good) == [("USA", 2000, 1.5, None)]
    assert rows(out.rejected, "ISO3", "more", "rejected") == [("DEU", 3, ["score"]), ("FRA", 2, ["year"])]
    assert out.good.count() + out.rejected.count() == df.count()
    with pytest.raises(ValueError):
        conform(spark.sql("SELECT 1 AS a, 2 AS b").toDF("x.Y", "X.y"), TARGET)


def test_load_replaces_the_table_and_counts(spark, tmp_path, rows):
    root = str(tmp_path / "scores")
    first = spark.createDataFrame([("USA", "2000"), ("FRA", "x")], "ISO3 string, year string")
    assert loaded(spark, root, TARGET).count() == 0
    assert load(first, TARGET, root).first()[:] == (1, 1, ["score", "note"], [])
    assert rows(load_rejects(spark, root, first.schema)) == [("FRA", "x", ["year"])]
    assert load(first.limit(1), TARGET, root).first()[:2] == (1, 0)
    assert rows(loaded(spark, root, TARGET), "iso3", "year") == [("USA", 2000)]
    assert load_rejects(spark, root, first.schema).count() == 0


def test_a_failed_load_keeps_the_former_table(spark, tmp_path, rows):
    root = str(tmp_path / "scores")
    good = spark.createDataFrame([("USA", "2000"), ("FRA", "x")], "ISO3 string, year string")
    load(good, TARGET, root)
    broken = good.withColumn("year", F.raise_error(F.lit("source lost")).cast("string"))
    with pytest.raises(Exception, match="source lost"):
        load(broken, TARGET, root)
    assert rows(loaded(spark, root, TARGET), "iso3") == [("USA",)] and load_rejects(spark, root, good.schema).count() == 1


def test_load_reads_its_source_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return x

    df = spark.createDataFrame([(str(i), str(i)) for i in range(40)], "ISO3 string, year string")
    load(df.withColumn("ISO3", counted("ISO3")), TARGET, str(tmp_path / "once"))
    assert seen.value == 40


def test_publish_in_folders_and_order(spark, tmp_path):
    root = str(tmp_path / "laid")
    df = spark.range(1000).select(
        (F.col("id") % 3).cast("string").alias("part"), (F.hash("id") % 97).alias("key"), F.col("id").alias("value")
    )
    publish(spark, root, {"t": df}, ["t"], {"t": Layout(["part"], ["key"])})
    back = published(spark, root, "t")
    assert back.columns == df.columns and sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    path = live_run(spark, root).first()["path"]
    assert {f.name for f in __import__("pathlib").Path(path).iterdir() if f.is_dir()} == {"part=0", "part=1", "part=2"}
    for file in __import__("pathlib").Path(path).rglob("*.parquet"):
        keys = [r["key"] for r in spark.read.parquet(str(file)).collect()]
        assert keys == sorted(keys)


def test_lookup_ladder(spark, rows):
    codes = spark.createDataFrame([("both",), ("LUR",), ("none",), ("both",)], "indicator string")
    first = spark.createDataFrame([("both", "World's first")], "code string, label string")
    second = known_names(spark).unionByName(spark.createDataFrame([("both", "second")], "code string, label string"))
    assert rows(dim_indicator(codes, [(first, "WDI"), (second, "IMF")])) == [
        ("LUR", "Unemployment Rate (%)", "IMF"),
        ("both", "World's first", "WDI"),
        ("none", "none", "Unknown"),
    ]
    assert len(KNOWN_NAMES) == 7


def test_entity_dimension(spark, rows):
    df = spark.createDataFrame([("CIV", "Cote d'Ivoire", None, "LMC"), ("USA", "United States", "NAC", None)], "id string, value string, region string, incomeLevel string")
    assert rows(dim_entity(df)) == [("CIV", "Cote d'Ivoire", "", "LMC"), ("USA", "United States", "NAC", "")]


def test_reports(spark, rows):
    scores = spark.createDataFrame([("a", 90.0), ("b", 95.0), ("c", 90.0), ("d", None)], "entity string, readiness_score double")
    entities = spark.createDataFrame([("a", "A", "x", ""), ("b", "B", "y", "")], "entity string, name string, region string, income_group string")
    assert rows(top_ranked(scores, 3), "rank", "entity") == [(1, "b"), (2, "a"), (2, "c")]
    assert rows(top_ranked(scores, 2), "entity") == [("a",), ("b",)]
    assert rows(score_by_region(scores, entities), "entity", "name") == [("a", "A"), ("b", "B"), ("c", None), ("d", None)]
    assert rows(score_by_region(scores, entities, ["y"]), "entity") == [("b",)]


def test_top_ranked_does_not_sort_everything(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("entity"), F.rand().alias("readiness_score"))
    assert "TakeOrderedAndProject" in top_ranked(df, 5)._jdf.queryExecution().executedPlan().toString()


def test_over_event_time(spark):
    fact = spark.createDataFrame(
        [("A", 1, 1, "x", "S", 2.0), ("A", 1, 0, "x", "S", 1.0), ("A", 1, 0, "y", "S", 3.0), ("B", 1, 0, "x", "S", 4.0)],
        "entity string, event_at int, offset int, indicator string, source string, value double",
    )
    names = spark.createDataFrame([("x", "Ex", "S")], "indicator string, name string, source string")
    got = over_event_time(fact, names, "x", ["A"]).collect()
    assert [(r.offset, r.value, r.indicator_name) for r in got] == [(0, 1.0, "Ex"), (1, 2.0, "Ex")]
    assert {r.indicator_name for r in over_event_time(fact, names).collect()} == {"Ex", "y"}


def test_publish_switches_all_tables_at_once(spark, tmp_path, rows):
    root = str(tmp_path)
    assert live_run(spark, root).count() == 0
    with pytest.raises(LookupError):
        published(spark, root, "a")
    manifest = publish(spark, root, {"a": spark.range(3), "b": spark.range(5)})
    assert rows(manifest, "name", "n_rows") == [("a", 3), ("b", 5)]
    publish(spark, root, {"a": spark.range(4), "b": spark.range(6)})
    assert (published(spark, root, "a").count(), published(spark, root, "b").count()) == (4, 6)


@pytest.mark.parametrize("prior", [True, False])
def test_failed_publish_leaves_the_prior_run(spark, tmp_path, prior):
    root = str(tmp_path)
    if prior:
        publish(spark, root, {"a": spark.range(3), "b": spark.range(3), "c": spark.range(3)})
    broken = spark.range(5).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        publish(spark, root, {"a": spark.range(9), "b": broken, "c": spark.range(9)})
    with pytest.raises(PublishFailed):
        publish(spark, root, {"a": spark.range(9), "b": spark.range(0)}, required=["b"])
    if prior:
        assert published(spark, root, "a").count() == 3
    else:
        assert live_run(spark, root).count() == 0


def test_write_sorted(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(0, 1000, 1, 4).select((F.col("id") % 7).alias("a"), (-F.col("id")).alias("b"), (F.col("id") % 2).alias("p"))
    write_sorted(df, path, ["a", "b"], ["p"])
    back = spark.read.parquet(path)
    assert back.count() == 1000 and set(back.columns) == {"a", "b", "p"}
    for part in (tmp_path / "t").glob("p=*/*.parquet"):
        got = [(r.a, r.b) for r in spark.read.parquet(str(part)).collect()]
        assert got == sorted(got)
    write_sorted(df.limit(10), path, ["a", "b"], ["p"])
    assert spark.read.parquet(path).count() == 10


def test_broadcast_only_below_the_measured_limit(spark):
    df = spark.createDataFrame([("x" * 100, 1)] * 10, "a string, b int")
    assert measured_bytes(df) == 10 * (16 + 16 + 100 + 8)
    hinted = lambda d: "broadcast" in d._jdf.queryExecution().analyzed().toString().lower()
    assert hinted(broadcast_if_small(df)) and not hinted(broadcast_if_small(df, 1000))
    assert hinted(stage_side(df, "t")) and not hinted(stage_side(df, "t", 1000))
    assert stage_side(df.limit(0), "t").count() == 0


def test_stage_goes_to_the_shared_folder(spark):
    staged = stage(spark.range(3), "t")
    folder = spark.conf.get("spark.checkpoint.dir", None)
    assert staged.count() == 3
    if folder:
        assert all(folder in f for f in staged.inputFiles())


def test_staging_needs_a_shared_folder_off_local_masters(spark):
    from types import SimpleNamespace

    from beforeafter.staging import shared_dir

    unset = SimpleNamespace(get=lambda key, default: default)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(conf=unset, sparkContext=SimpleNamespace(master="local-cluster[3,2,1024]")))
    assert shared_dir(SimpleNamespace(conf=unset, sparkContext=SimpleNamespace(master="local[4]")))
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
