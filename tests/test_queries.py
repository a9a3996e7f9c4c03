import os
import subprocess
import sys

import pytest
from check_oracle import answer, compare, connect, plain

from __spark_entry__ import entry, oracle_sql, queries
from beforeafter.plans.oracle import ORACLE
from beforeafter.plans.queries import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, con, name):
    df = queries()[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert compare(plain(df.toPandas()), plain(answer(con, oracle_sql()[name]))) == ""


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    """As if every side were too large: limits at zero here and in Spark."""
    import beforeafter.operators.windows as windows
    import beforeafter.staging as staging

    monkeypatch.setattr(windows, "BROADCAST_BYTES", -1)
    for f in (staging.broadcast_if_small, staging.stage_side):
        monkeypatch.setattr(f, "__defaults__", (-1,))
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


@pytest.mark.parametrize(
    "name",
    ["event_window_change_raw", "pre_event_mean", "correlation_kept", "snapshot_latest_per_source", "dim_indicator", "entity_filter_fallback"],
)
def test_query_equals_sql_without_broadcasts(spark, sf_dir, con, no_broadcast, name):
    df = queries()[name](spark, sf_dir)
    assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
    assert compare(plain(df.toPandas()), plain(answer(con, oracle_sql()[name]))) == ""


def test_entry(spark):
    df = entry(spark)
    assert df.columns[0] == "entity" and df.count() > 0


@pytest.mark.parametrize("missing", ["xxhash", "beforeafter.llm", "beforeafter.llm.queries"])
def test_core_queries_stay_without_an_optional_library(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(*e.queries(), *e.oracle_sql())"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    assert set(done.stdout.split()) == set(QUERIES)
