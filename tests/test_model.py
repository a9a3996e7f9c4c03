import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from beforeafter.functions import interpolate, signed_log
from beforeafter.operators.axes import anchored, fit_axes, project
from beforeafter.operators.medians import exact_median
from beforeafter.operators.enclosing import add_distance, fit_ball
from beforeafter.operators.one_class import add_label, fit_boundary, smallest_mean
from beforeafter.operators.scaling import Scaling, reference_stats, scaled_long, scaled_rows
from beforeafter.operators.score import add_readiness, completeness, evaluate, score_rows
from beforeafter.operators.sparse import (
    add_label_sparse,
    fit_axes_sparse,
    fit_boundary_sparse,
    offset_of,
    project_sparse,
    sparse_rows,
)
from beforeafter.operators.snapshots import snapshot_at_event, snapshot_latest
from beforeafter.plans.scoring import prepare, score_candidates
from beforeafter.staging import stage

PANEL = "source string, entity string, indicator string, time int, value double"
REFERENCE = "entity string, event_at int, indicator string, value double"
KEYS = ["entity", "event_at"]


def as_rows(spark, z):
    return spark.createDataFrame([(f"e{i}", [float(v) for v in row]) for i, row in enumerate(z)], "entity string, z array<double>")


def long_of(spark, x, codes):
    rows = [(f"e{i}", i, c, float(v)) for i, r in enumerate(x) for c, v in zip(codes, r) if not np.isnan(v)]
    return spark.createDataFrame(rows, REFERENCE)


def numpy_scaled(train, other):
    """The definition: log, fill with train medians, scale with train mean and deviation."""
    logs = [np.sign(x) * np.log1p(np.abs(x)) for x in (train, other)]
    med = np.nanmedian(logs[0], axis=0)
    filled = [np.where(np.isnan(x), med, x) for x in logs]
    mean, sd = filled[0].mean(axis=0), filled[0].std(axis=0)
    sd = np.where(np.ptp(filled[0], axis=0) == 0, 1.0, sd)
    return [(x - mean) / sd for x in filled]


def sample(seed, n, m, k, gaps=0.25):
    rng = np.random.default_rng(seed)
    spread = np.linspace(5.0, 0.5, k)
    train, other = (np.exp(rng.normal(size=(r, k)) * spread) * rng.choice([-1, 1], size=(r, k)) for r in (n, m))
    for x in (train, other):
        x[rng.random(x.shape) < gaps] = np.nan
    train[0], other[0] = 1.0, 2.0  # every code on both sides
    return train, other


def test_signed_log(spark):
    df = spark.createDataFrame([(-3.0,), (0.0,), (1e12,)], "x double").select(signed_log(F.col("x")).alias("y"))
    assert [r.y for r in df.collect()] == pytest.approx([-np.log(4), 0.0, np.log1p(1e12)])


def test_interpolate_equals_numpy(spark):
    xs = [-9.0, -2.0, -1.0, 0.0, 0.5, 3.0, 4.0, 9.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for px, py in (([-2.0, 0.0, 4.0], [20, 50, 95]), ([-2.0, -2.0, 4.0], [20, 50, 95])):
        knots = [(F.lit(a), F.lit(float(b))) for a, b in zip(px, py)]
        got = [r.y for r in df.select(interpolate(F.col("x"), knots).alias("y")).collect()]
        assert got == pytest.approx(list(np.interp(xs, px, py)))
        assert got == sorted(got) and min(got) == 20 and max(got) == 95


def test_snapshots(spark, rows):
    panel = spark.createDataFrame(
        [("W", "A", "x", 1, 1.0), ("W", "A", "x", 2, 2.0), ("I", "A", "y", 3, 3.0), ("I", "A", "x", 2, 9.0)], PANEL
    )
    assert rows(snapshot_latest(panel)) == [("A", "y", 3.0)]
    assert rows(snapshot_latest(panel, "per_source")) == [("A", "x", 2.0), ("A", "y", 3.0)]
    assert rows(snapshot_latest(panel, 2, "prefer_source", ["I"])) == [("A", "x", 9.0)]
    assert rows(snapshot_latest(panel, 2, "mean")) == [("A", "x", 5.5)]
    with pytest.raises(Exception, match="repeated key"):
        snapshot_latest(panel, 2).collect()
    events = spark.createDataFrame([("A", 1), ("A", 1), ("A", 3), ("B", 1)], "entity string, event_at int")
    assert rows(snapshot_at_event(panel, events)) == [("A", 1, "x", 1.0), ("A", 3, "y", 3.0)]


def test_median_of_an_even_number(spark, rows):
    df = spark.createDataFrame([("a", v) for v in (1.0, 2.0, 10.0, 20.0)] + [("b", 5.0), ("b", None)], "indicator string, value double")
    assert rows(exact_median(df)) == [("a", 6.0), ("b", 5.0)]


@pytest.mark.parametrize(
    "kind, n", [("spread", 3000), ("spread", 3001), ("outliers", 3000), ("copies", 3001), ("two values", 3000)]
)
def test_median_of_hot_keys(spark, kind, n):
    rng = np.random.default_rng(n)
    hot = {
        "spread": rng.normal(size=n),
        "outliers": np.concatenate([10.0 ** rng.uniform(-300, 300, n - 5), [-1e308, 1e308, 0, 0, 0]]),
        "copies": np.where(rng.random(n) < 0.6, 7.0, rng.normal(size=n)),
        "two values": np.where(np.arange(n) < n // 2, 1.0, 2.0),
    }[kind]
    rows = [("hot", float(v)) for v in hot] + [("cold", float(v)) for v in range(10)]
    df = spark.createDataFrame(rows, "indicator string, value double").repartition(6)
    got = {r.indicator: r["median"] for r in exact_median(df, group_limit=100).collect()}
    assert got == {"hot": np.median(hot), "cold": 4.5}


@pytest.mark.parametrize("group_limit", [1_000_000, 10])
def test_scaling_equals_numpy(spark, group_limit):
    codes = [f"c.{j}" for j in range(6)]
    train, other = sample(3, 25, 12, 6)
    train[:, 2] = 4.0  # no spread
    reference, candidates = long_of(spark, train, codes), long_of(spark, other, codes)
    indicators = reference.select("indicator").distinct()
    scaling = Scaling.of(reference_stats(reference, indicators, group_limit=group_limit))
    want_train, want_other = numpy_scaled(train, other)
    got = {r.event_at: r.z for r in scaled_rows(reference, scaling, KEYS).collect()}
    assert np.allclose([got[i] for i in range(25)], want_train)
    got = {r.event_at: r.z for r in scaled_rows(candidates, scaling, KEYS).collect()}
    assert np.allclose([got[i] for i in range(12) if i in got], want_other)
    cells = scaled_long(scaled_rows(candidates, scaling, KEYS), scaling, KEYS).collect()
    assert {(r.event_at, r.indicator): r.scaled for r in cells}[3, "c.4"] == pytest.approx(want_other[3, 4])


def test_a_candidate_without_known_indicators_gets_medians(spark):
    reference = spark.createDataFrame([("a", 1, "x", 1.0), ("b", 1, "x", 3.0), ("b", 1, "gone", None)], REFERENCE)
    scaling = Scaling.of(reference_stats(reference, reference.select("indicator").distinct()))
    assert scaling.indicators == ["x"]
    row = scaled_rows(spark.createDataFrame([("q", 1, "other", 5.0)], REFERENCE), scaling, KEYS).first()
    assert row.z == pytest.approx([0.0])


def test_nothing_in_common_is_an_error(spark):
    reference = spark.createDataFrame([("a", 1, "x", 1.0)], REFERENCE)
    with pytest.raises(ValueError, match="share no indicator"):
        prepare(reference, spark.createDataFrame([("a", "y", 1.0)], "entity string, indicator string, value double"))


def test_axes_equal_numpy(spark):
    train, other = numpy_scaled(*sample(8, 60, 20, 5, 0.1))
    train *= np.array([3.0, 2.0, 1.0, 0.5, 0.2])
    train -= train.mean(axis=0)
    axes = fit_axes(as_rows(spark, train))
    values, vectors = np.linalg.eigh(np.cov(train.T))
    want = vectors[:, np.argsort(values)[::-1][:2]]
    want = want * np.sign(want[np.abs(want).argmax(axis=0), range(2)])
    assert np.allclose(axes.loadings, want, atol=1e-8)
    got = project(as_rows(spark, other), axes).select("entity", "axis_1", "axis_2").collect()
    assert np.allclose([[r.axis_1, r.axis_2] for r in got], other @ want)


def test_anchors_turn_the_first_axis(spark):
    frame = spark.createDataFrame([("USA", -1.0), ("ZWE", 2.0), ("FRA", 0.5)], "entity string, axis_1 double")
    turned = {r.entity: r.axis_1 for r in anchored(frame, frame, "USA", "ZWE").collect()}
    assert turned == {"USA": 1.0, "ZWE": -2.0, "FRA": -0.5}
    for high, low in (("ZWE", "USA"), ("USA", "nobody"), ("USA", "USA")):
        assert {r.entity: r.axis_1 for r in anchored(frame, frame, high, low).collect()}["USA"] == -1.0


def frank_wolfe(gram, cap, steps=20_000):
    """Another way to the same weights, slow but simple."""
    n = len(gram)
    alpha = np.full(n, 1.0 / n)
    for _ in range(steps):
        grad = gram @ alpha
        corner, left = np.zeros(n), 1.0
        for i in np.argsort(grad):
            corner[i] = min(cap, left)
            left -= corner[i]
        move = corner - alpha
        slope, curve = grad @ move, move @ gram @ move
        if -slope < 1e-10:
            break
        alpha = alpha + min(1.0, -slope / curve) * move
    return alpha


def test_boundary_equals_another_solver(spark):
    rng = np.random.default_rng(4)
    train, other = rng.normal(size=(60, 8)), rng.normal(scale=1.5, size=(40, 8))
    boundary = fit_boundary(as_rows(spark, train))
    assert boundary.gamma == 1 / 8 and boundary.gap <= 1e-12 and boundary.rows_used == 60
    d = ((train[:, None] - train[None]) ** 2).sum(-1)
    gram = np.exp(-d / 8)
    alpha = frank_wolfe(gram, 1 / (0.05 * 60))
    cross = np.exp(-((other[:, None] - train[None]) ** 2).sum(-1) / 8)
    got = np.array([r.decision for r in add_label(as_rows(spark, other), boundary).collect()])
    shift = (cross @ alpha - got).mean()
    assert np.allclose(got, cross @ alpha - shift, atol=2e-3)
    own = np.array([r.decision for r in add_label(as_rows(spark, train), boundary).collect()])
    # At most a share nu of the reference rows lies outside.
    assert (own < -1e-9).sum() <= 3
    labels = {r.anomaly_label for r in add_label(as_rows(spark, np.full((1, 8), 9.0)), boundary).collect()}
    assert labels == {-1}


def test_one_more_row_changes_no_algorithm(spark):
    rng = np.random.default_rng(2)
    train, other = rng.normal(size=(301, 6)), rng.normal(scale=1.4, size=(400, 6))
    few, more = (stage(as_rows(spark, train[:n]).repartition(4), "test-reference") for n in (300, 301))
    a, b = fit_boundary(few, fit_rows=400), fit_boundary(more, fit_rows=400)
    assert (a.rows_seen, a.rows_used, b.rows_seen, b.rows_used) == (300, 300, 301, 301) and max(a.gap, b.gap) <= 1e-12
    assert ((a.values(other) > 0) == (b.values(other) > 0)).mean() > 0.99
    part, again = fit_boundary(more, fit_rows=100), fit_boundary(more.repartition(7), fit_rows=100)
    assert (part.rows_seen, part.rows_used) == (301, 100)
    assert np.allclose(part.values(other), again.values(other))


def test_a_fit_that_does_not_settle_raises():
    with pytest.raises(ArithmeticError, match="not settled"):
        smallest_mean(np.diag([1.0, 2.0, 4.0]), 1.0, max_steps=1)


def test_axes_of_wide_rows_equal_numpy(spark):
    rng = np.random.default_rng(12)
    z = rng.normal(size=(90, 400)) * np.linspace(3, 0.3, 400) + rng.normal(size=400)
    axes = fit_axes(stage(as_rows(spark, z), "test-wide"), 3)
    _, _, turn = np.linalg.svd(z - z.mean(axis=0), full_matrices=False)
    want = turn[:3].T
    want = want * np.sign(want[np.abs(want).argmax(axis=0), range(3)])
    assert np.allclose(axes.loadings, want, atol=1e-8)


def test_a_repeated_indicator_of_a_row_raises(spark):
    reference = spark.createDataFrame([("a", 1, "x", 1.0), ("b", 1, "x", 3.0)], REFERENCE)
    scaling = Scaling.of(reference_stats(reference, reference.select("indicator").distinct()))
    with pytest.raises(Exception, match="repeated key and indicator"):
        scaled_rows(reference.unionByName(reference), scaling, KEYS).collect()


def test_smallest_mean_respects_the_cap():
    gram = np.diag([1.0, 2.0, 4.0])
    alpha, gap = smallest_mean(gram, 1.0)
    assert alpha == pytest.approx(np.array([4, 2, 1]) / 7) and gap < 1e-8
    alpha, _ = smallest_mean(gram, 0.4)
    assert alpha.max() <= 0.4 + 1e-12 and alpha.sum() == pytest.approx(1.0)


AXES = "entity string, axis_1 double, axis_2 double"


def test_readiness_equals_numpy(spark):
    rng = np.random.default_rng(9)
    ref, cand = rng.normal(size=(30, 2)), rng.normal(scale=3, size=(50, 2))
    frames = [spark.createDataFrame([(f"e{i}", float(a), float(b)) for i, (a, b) in enumerate(x)], AXES) for x in (ref, cand)]
    got = {r.entity: r for r in add_readiness(frames[1], frames[0]).collect()}
    centre = ref.mean(axis=0)
    raw = (ref - centre) @ [1.5, 1.0]
    want = np.interp((cand - centre) @ [1.5, 1.0], [raw.min(), raw.mean(), raw.max()], [20, 50, 95])
    assert [got[f"e{i}"].readiness for i in range(50)] == pytest.approx(list(want))
    assert got["e7"].lead == pytest.approx(cand[7, 0] - centre[0])


def test_a_single_reference_row_gives_the_middle(spark):
    one = spark.createDataFrame([("r", 1.0, 1.0)], AXES)
    out = add_readiness(spark.createDataFrame([("a", 9.0, 0.0), ("b", -9.0, 0.0)], AXES), one).collect()
    assert [(r.readiness, r.degenerate) for r in out] == [(50.0, True)] * 2


def test_completeness_and_result_rows(spark, rows):
    cells = spark.createDataFrame(
        [("a", "x", 1.0), ("a", "y", None), ("a", "z", 2.0), ("b", "z", 1.0)], "entity string, indicator string, value double"
    )
    common = spark.createDataFrame([("w",), ("x",), ("y",)], "indicator string")
    complete = completeness(cells, common)
    assert rows(complete) == [("a", pytest.approx(1 / 3)), ("b", 0.0)]
    scored = spark.createDataFrame([("a", 1, 51.239), ("b", -1, 20.0)], "entity string, anomaly_label int, readiness double")
    assert rows(score_rows(scored, complete)) == [("a", 1, 0.3333, 51.24), ("b", -1, 0.0, 20.0)]


def test_status_report(spark):
    scored = spark.createDataFrame(
        [("USA", -1, 95.0, 3.0), ("FRA", 1, 61.26, 1.0), ("ZWE", -1, 20.0, -2.0)],
        "entity string, anomaly_label int, readiness double, lead double",
    )
    asked = spark.createDataFrame([("USA",), ("FRA",), ("ZWE",), ("XXX",), ("USA",)], "entity string")
    got = {r.entity: (r.status, r.report) for r in evaluate(scored, asked).collect()}
    assert got == {
        "USA": ("ELITE CANDIDATE", "USA: ELITE CANDIDATE, viability index 95.0 / 100"),
        "FRA": ("STANDARD VIABLE", "FRA: STANDARD VIABLE, viability index 61.3 / 100"),
        "ZWE": ("HIGH RISK / DEVELOPING", "ZWE: HIGH RISK / DEVELOPING, viability index 20.0 / 100"),
        "XXX": (None, "XXX: not found"),
    }


def test_score_candidates_equals_numpy(spark):
    train, other = sample(21, 40, 30, 5)
    codes = [f"c.{j}" for j in range(5)]
    candidates = long_of(spark, other, codes).drop("event_at")
    scored = score_candidates(long_of(spark, train, codes), candidates, anchors=("e1", "e2"))
    zt, zo = numpy_scaled(train, other)
    values, vectors = np.linalg.eigh(np.cov(zt.T))
    load = vectors[:, np.argsort(values)[::-1][:2]]
    load = load * np.sign(load[np.abs(load).argmax(axis=0), range(2)])
    pt, po = zt @ load, zo @ load
    if po[1, 0] < po[2, 0]:
        pt[:, 0], po[:, 0] = -pt[:, 0], -po[:, 0]
    raw = pt @ [1.5, 1.0]
    want = np.interp(po @ [1.5, 1.0] - raw.mean(), [raw.min() - raw.mean(), 0, raw.max() - raw.mean()], [20, 50, 95])
    got = {r.entity: r for r in scored.scores.collect()}
    assert len(got) == len(set(f"e{i}" for i in range(30) if not np.isnan(other[i]).all()))
    for e, r in got.items():
        i = int(e[1:])
        assert r.readiness_score == pytest.approx(want[i], abs=0.006)
        assert r.data_completeness == pytest.approx(np.mean(~np.isnan(other[i])), abs=1e-4)
        assert r.anomaly_label in (1, -1)


def test_ball_holds_all_reference_rows_within_its_bound(spark):
    rng = np.random.default_rng(4)
    train = np.concatenate([rng.normal(size=(8000, 4)), rng.normal(size=(40, 4)) * 4])
    rows = as_rows(spark, train).repartition(6).cache()
    ball = fit_ball(rows, epsilon=0.02)
    distances = np.array([r["distance"] for r in add_distance(rows, ball).collect()])
    assert ball.rows_seen == 8040 and ball.core_rows < 400 and distances.max() <= 1.02 * ball.radius
    assert abs(distances.max() - ball.farthest) < 1e-9
    # The radius is no larger than the least one, which any ball's farthest row bounds.
    finer = fit_ball(rows, epsilon=0.001)
    assert ball.radius <= finer.farthest and finer.radius <= ball.farthest and finer.core_rows >= ball.core_rows
    again = fit_ball(rows.repartition(11), epsilon=0.02)
    assert np.array_equal(np.sort(again.points, axis=0), np.sort(ball.points, axis=0)) and again.radius == ball.radius
    labels = {r["anomaly_label"] for r in add_distance(rows, ball).collect()}
    assert labels == {1}
    with pytest.raises(ArithmeticError):
        fit_ball(rows, epsilon=1e-6, max_core=40)


def test_ball_equals_the_exact_one_on_few_rows(spark):
    rng = np.random.default_rng(9)
    train = rng.normal(size=(70, 5))
    ball = fit_ball(as_rows(spark, train), epsilon=1e-11)
    gram = np.exp(-((train[:, None] - train[None]) ** 2).sum(-1) / 5)
    weights, _ = smallest_mean(gram, 1.0)
    want = np.sqrt(1 + weights @ gram @ weights - 2 * gram @ weights)
    got = ball.distances(train)
    assert np.allclose(got, want, atol=1e-7) and np.isclose(ball.radius, want.max(), atol=1e-9)


def test_ball_leaves_a_share_outside(spark):
    rng = np.random.default_rng(3)
    rows = as_rows(spark, rng.normal(size=(1000, 3))).cache()
    for share in (0.05, 0.5, 1.0):
        ball = fit_ball(rows, epsilon=0.01, outside=share)
        distances = np.sort(ball.distances(np.array([r["z"] for r in rows.collect()])))
        allowed = int(share * 1000)
        assert (distances > ball.limit + 1e-9).sum() <= allowed
        if share < 1:
            exact = distances[999 - allowed]
            assert exact <= ball.limit + 1e-9 and ball.limit - exact <= ball.farthest / 4096**2 + 1e-9
    same = fit_ball(as_rows(spark, np.ones((50, 3))), outside=0.1)
    assert same.core_rows == 1 and same.radius == 0 and {r["anomaly_label"] for r in add_distance(as_rows(spark, np.ones((2, 3))), same).collect()} == {1}


@pytest.mark.parametrize("gaps", [0.0, 0.3, 0.95])
def test_sparse_rows_give_the_dense_results(spark, gaps):
    train, other = sample(21, 60, 130, 12, gaps)
    other[5, 1:] = np.nan
    codes = [f"c{j:02}" for j in range(12)]
    reference, candidates = long_of(spark, train, codes), long_of(spark, other, codes)
    # A row without any value of a known indicator is one of medians.
    candidates = candidates.unionByName(spark.createDataFrame([("none", 7, "unknown", 1.0)], REFERENCE))
    stats = reference_stats(reference, reference.select("indicator").distinct())
    scaling = Scaling.of(stats)
    offset = offset_of(scaling)
    dense = {r["entity"]: np.array(r["z"]) for r in scaled_rows(candidates, scaling, KEYS).collect()}
    sparse = {r["entity"]: r for r in sparse_rows(candidates, scaling, KEYS).collect()}
    assert dense.keys() == sparse.keys()
    for entity, z in dense.items():
        row = offset.copy()
        row[sparse[entity]["slots"]] += sparse[entity]["deltas"]
        assert np.allclose(row, z, atol=1e-12)
    assert not sparse["none"]["slots"]
    refs, sparse_refs = stage(scaled_rows(reference, scaling, KEYS), "t"), stage(sparse_rows(reference, scaling, KEYS), "t")
    axes, sparse_axes = fit_axes(refs, 2), fit_axes_sparse(sparse_refs, offset, 2)
    assert np.allclose(axes.loadings, sparse_axes.loadings, atol=1e-7)
    boundary, sparse_boundary = fit_boundary(refs), fit_boundary_sparse(sparse_refs, offset)
    a = {r["entity"]: r for r in add_label(project(scaled_rows(candidates, scaling, KEYS), axes), boundary).collect()}
    b = project_sparse(sparse_rows(candidates, scaling, KEYS), sparse_axes, offset)
    for r in add_label_sparse(b, sparse_boundary, offset).collect():
        want = a[r["entity"]]
        assert np.allclose([r["axis_1"], r["axis_2"], r["decision"]], [want["axis_1"], want["axis_2"], want["decision"]], atol=1e-6)


def test_sparse_kernel_in_steps_equals_dense(monkeypatch):
    rng = np.random.default_rng(8)
    import beforeafter.operators.sparse as sparse

    offset, points, weights = rng.normal(size=40), rng.normal(size=(7, 40)), rng.random(7)
    slots = [sorted(rng.choice(40, size=k, replace=False).tolist()) for k in (0, 3, 40, 1, 0, 9, 2)]
    deltas = [rng.normal(size=len(s)).tolist() for s in slots]
    z = np.tile(offset, (len(slots), 1))
    for row, s, x in zip(z, slots, deltas):
        row[s] += x
    want = np.exp(-0.05 * ((z[:, None] - points[None]) ** 2).sum(-1)) @ weights
    for numbers in (1, 30, 1 << 21):
        monkeypatch.setattr(sparse, "STEP_NUMBERS", numbers)
        got = sparse._kernel_sums(pd.Series(slots), pd.Series(deltas), offset, points, weights, 0.05)
        assert np.allclose(got, want, atol=1e-12)


def test_sparse_rows_take_the_room_of_their_values(spark, tmp_path):
    codes = [f"c{j:04}" for j in range(2000)]
    reference = spark.createDataFrame([(f"r{i}", i, c, float(i * (j % 7 + 1))) for i in range(4) for j, c in enumerate(codes)], REFERENCE)
    scaling = Scaling.of(reference_stats(reference, reference.select("indicator").distinct()))
    few = spark.createDataFrame([(f"e{i}", i, codes[(i * 31 + j) % 2000], float(i + j)) for i in range(500) for j in range(3)], REFERENCE)

    def stored(df, name):
        df.coalesce(1).write.option("compression", "none").parquet(f"{tmp_path}/{name}")
        return sum(f.stat().st_size for f in (tmp_path / name).glob("*.parquet"))

    assert stored(sparse_rows(few, scaling, KEYS), "sparse") * 20 < stored(scaled_rows(few, scaling, KEYS), "dense")
