"""Time the study's jobs over a panel of 8.4 million rows.

    python tools/bench_panel.py [sf_dir]

The panel has the shape of the country study (266 entities, 1,541 indicators, 65
years, 33 events) and is spread from the item rows of sf0.1, fourteen observations
each; repeated keys stay. Prints seconds per step, one run each.
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from beforeafter.operators.correlation import correlated_later, correlation_pairs  # noqa: E402
from beforeafter.operators.snapshots import snapshot_at_event, snapshot_latest  # noqa: E402
from beforeafter.operators.windows import event_window_change, pre_event_means  # noqa: E402
from beforeafter.operators.features import null_filter  # noqa: E402
from beforeafter.plans.scoring import score_candidates  # noqa: E402
from beforeafter.plans.supplied import table  # noqa: E402
from beforeafter.staging import stage  # noqa: E402


def build_panel(spark: SparkSession, sf_dir: str):
    items = table(spark, sf_dir, "lineitem").repartition(8)
    copies = items.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(13))))

    def spread(label: str, n: int):
        key = F.xxhash64(F.lit(label), "l_orderkey", "l_partkey", "l_linenumber", "copy")
        return F.pmod(key, F.lit(n)).cast("int")

    return copies.select(
        F.when(spread("s", 10) < 9, "WDI").otherwise("IMF").alias("source"),
        F.format_string("E%03d", spread("e", 266)).alias("entity"),
        F.format_string("I.%04d", spread("i", 1541)).alias("indicator"),
        (spread("t", 65) + 1960).alias("time"),
        (F.col("l_extendedprice") * (1 + spread("v", 1000))).alias("value"),
    )


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="beforeafter-"))
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(label, work):
        start = time.perf_counter()
        out = work()
        print(f"{label}: {time.perf_counter() - start:.1f} s", flush=True)
        return out

    panel = timed("write panel", lambda: stage(build_panel(spark, sf_dir), "bench-panel"))
    events = panel.select("entity").distinct().orderBy("entity").limit(33).select(
        "entity", (F.lit(1966) + F.pmod(F.xxhash64("entity"), F.lit(52))).cast("int").alias("event_at")
    )
    events = stage(events, "bench-events")
    print("panel rows:", panel.count(), "events:", events.count())
    fact = timed("event window fact", lambda: stage(event_window_change(panel, events), "bench-fact"))
    print("fact rows:", fact.count())
    means = timed("pre-event means", lambda: stage(pre_event_means(panel, events), "bench-means"))
    kept = timed("null filter", lambda: stage(null_filter(means), "bench-kept"))
    print("features:", kept.count(), "indicators:", kept.select("indicator").distinct().count())
    pairs = timed("correlation pairs", lambda: stage(correlation_pairs(kept), "bench-pairs"))
    print("pairs:", pairs.count(), "dropped:", correlated_later(pairs).count())
    reference = snapshot_at_event(panel, events, "mean")
    candidates = snapshot_latest(panel, duplicates="mean")
    scores = timed("scores", lambda: score_candidates(reference, candidates, ("E000", "E001")).scores.collect())
    print("scores:", len(scores))


if __name__ == "__main__":
    main()
