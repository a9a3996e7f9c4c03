import numpy as np
import pandas as pd
import pytest

from beforeafter.operators.correlation import _needed, _summed, correlated_later, correlated_pairs, correlation_pairs
from beforeafter.operators.features import common_indicators, missing_counts, null_filter, wide_matrix
from beforeafter.plans.features import training_features
from beforeafter.staging import stage

FEATURES = "entity string, event_at int, indicator string, avg_value double"


def long(spark, wide: pd.DataFrame):
    """A frame of one column per indicator, in long form without its gaps."""
    rows = [
        (f"e{i % 7}", i, code, float(v)) for code in wide for i, v in enumerate(wide[code]) if not pd.isna(v)
    ]
    return spark.createDataFrame(rows, FEATURES)


def pandas_pairs(wide: pd.DataFrame) -> dict:
    corr = wide[sorted(wide)].corr()
    return {
        (a, b): corr.loc[a, b]
        for i, a in enumerate(corr)
        for b in list(corr)[i + 1 :]
        if not np.isnan(corr.loc[a, b])
    }


def pandas_drops(wide: pd.DataFrame, threshold=0.9) -> list:
    return sorted({b for (a, b), r in pandas_pairs(wide).items() if abs(r) > threshold})


def random_wide(seed: int, n: int, k: int, gaps: float) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, 3))
    data = base @ rng.normal(size=(3, k)) + rng.normal(scale=0.4, size=(n, k))
    data = data * 10.0 ** rng.integers(-3, 9, size=k) + 10.0 ** rng.integers(0, 9, size=k)
    data[rng.random((n, k)) < gaps] = np.nan
    return pd.DataFrame(data, columns=[f"{'AbZ'[j % 3]}.{j}" for j in range(k)])


@pytest.mark.parametrize("rows_per_block, codes_per_block", [(2048, 256), (7, 5), (1000, 3)])
@pytest.mark.parametrize("seed, gaps", [(1, 0.0), (2, 0.3)])
def test_pairs_equal_pandas(spark, seed, gaps, rows_per_block, codes_per_block):
    wide = random_wide(seed, 40, 17, gaps)
    got = correlation_pairs(long(spark, wide), rows_per_block, codes_per_block)
    found = {(r.a, r.b): r.r for r in got.collect()}
    want = pandas_pairs(wide)
    assert found.keys() == want.keys()
    for pair, r in want.items():
        assert found[pair] == pytest.approx(r, abs=1e-6)
    assert sorted(r.indicator for r in correlated_later(got).collect()) == pandas_drops(wide)


def test_pair_edges(spark):
    nan = np.nan
    wide = pd.DataFrame(
        {
            "a": [1.0, 2.0, 3.0, 4.0, nan, nan],
            "b.flat": [0.1] * 6,
            "c.two": [nan, nan, 5.0, 6.0, 1.0, nan],  # two rows shared with a
            "d.one": [nan, nan, nan, 1.0, 2.0, 3.0],  # one row shared with a
            "e.neg": [-2.0, -4.0, -6.0, -8.0, 0.0, 1.0],
            "f.part": [7.0, 7.0, 7.0, 7.0, 1.0, 2.0],  # flat on the rows shared with a
        }
    )
    found = {(r.a, r.b): (r.n_rows, r.r) for r in correlation_pairs(long(spark, wide)).collect()}
    assert found["a", "c.two"] == (2, pytest.approx(1.0))
    assert found["a", "e.neg"] == (4, pytest.approx(-1.0))
    assert ("a", "d.one") not in found and ("a", "f.part") not in found
    assert not any("b.flat" in pair for pair in found)
    assert found.keys() == pandas_pairs(wide).keys()


def test_partial_sums_do_not_grow_with_blocks_of_rows():
    rng = np.random.default_rng(3)
    cells = pd.DataFrame(
        [
            (i, j, 0, rb, side, f"e{row}", 1, f"c{side}{k}", rng.normal())
            for i, j in ((0, 0), (0, 1))
            for rb in range(6)
            for row in range(rb * 10, rb * 10 + 10)
            for side in sorted({i, j})
            for k in range(5 if rb else 3)
        ],
        columns=["bi", "bj", "salt", "rb", "side", "entity", "event_at", "indicator", "z"],
    )
    one = cells.assign(rb=0)
    whole, parts = (pd.concat(_summed(iter([x]))) for x in (one, cells))
    cut = pd.concat(_summed(cells.iloc[at : at + 37] for at in range(0, len(cells), 37)))
    assert len(whole) == len(parts) == len(cut) == 10 + 25
    for other in (parts, cut):
        both = whole.merge(other, on=["a", "b"])
        assert len(both) == len(whole)
        assert all(np.allclose(both[f"{m}_x"], both[f"{m}_y"]) for m in ("n", "sa", "sb", "saa", "sbb", "sab"))


def test_exact_threshold_stays_and_chains_count(spark):
    # r(a, b) is exactly 0.9: b = 0.9 a + sqrt(0.19) c for a, c orthonormal.
    a = np.array([1.0, -1.0, 1.0, -1.0])
    c = np.array([1.0, 1.0, -1.0, -1.0])
    exact = pd.DataFrame({"a": a, "b": 0.9 * a + np.sqrt(0.19) * c})
    assert correlated_later(correlation_pairs(long(spark, exact))).count() == 0
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=200), rng.normal(size=200)
    chain = pd.DataFrame({"a": x, "b": x + 0.4 * y, "c": x + 0.9 * y})
    r = chain.corr()
    assert r.loc["a", "b"] > 0.9 and r.loc["b", "c"] > 0.9 > r.loc["a", "c"]
    dropped = correlated_later(correlation_pairs(long(spark, chain)))
    assert sorted(d.indicator for d in dropped.collect()) == ["b", "c"]


def test_null_filter_keeps_exactly_half(spark, rows):
    wide = pd.DataFrame({"full": [1.0] * 6, "half": [1.0] * 3 + [np.nan] * 3, "less": [1.0] * 2 + [np.nan] * 4})
    features = long(spark, wide)
    assert rows(missing_counts(features)) == [("full", 6, 0), ("half", 6, 3), ("less", 6, 4)]
    assert {r.indicator for r in null_filter(features).collect()} == {"full", "half"}
    # An event whose only row has no value still counts as a row.
    extra = features.unionByName(spark.createDataFrame([("z", 1, "full", None)], FEATURES))
    assert {r.indicator for r in null_filter(extra).collect()} == {"full"}


def test_wide_matrix_with_dots(spark):
    features = long(spark, pd.DataFrame({"b.Y": [1.0, np.nan], "A.X": [2.0, 3.0]}))
    wide = wide_matrix(features)
    assert wide.columns == ["entity", "event_at", "A.X", "b.Y"]
    assert [tuple(r) for r in wide.orderBy("event_at").collect()] == [("e0", 0, 2.0, 1.0), ("e1", 1, 3.0, None)]
    with pytest.raises(ValueError):
        wide_matrix(features, max_columns=1)


def test_common_indicators(spark, rows):
    a = spark.createDataFrame([("x",), ("y",), ("y",)], "indicator string")
    b = spark.createDataFrame([("y",), ("z",)], "indicator string")
    assert rows(common_indicators(a, b)) == [("y",)]


def test_training_features_end_to_end(spark):
    rng = np.random.default_rng(11)
    rows = []
    for e in range(12):
        for t in range(94, 100):
            x = rng.normal()
            rows += [("S", f"e{e}", "a", t, x), ("S", f"e{e}", "b", t, 2 * x + 1e-3 * rng.normal())]
            rows += [("S", f"e{e}", "c", t, rng.normal())]
            if e < 5:
                rows.append(("S", f"e{e}", "rare", t, 1.0))
    panel = spark.createDataFrame(rows, "source string, entity string, indicator string, time int, value double")
    events = spark.createDataFrame([(f"e{e}", 100) for e in range(12)], "entity string, event_at int")
    out = training_features(panel, events)
    kept = {r.indicator for r in out.collect()}
    assert kept == {"a", "c"}
    again = correlation_pairs(out)
    assert again.filter("abs(r) > 0.9").count() == 0


def family_wide(seed: int, n: int, families: int, each: int, gaps: float) -> pd.DataFrame:
    """Families of indicators that follow one course each, some of them turned over."""
    rng = np.random.default_rng(seed)
    courses = rng.normal(size=(n, families))
    data = np.repeat(courses, each, axis=1) + rng.normal(scale=0.15, size=(n, families * each))
    data *= np.where(rng.random(families * each) < 0.3, -1.0, 1.0) * 10.0 ** rng.integers(-3, 6, size=families * each)
    data[rng.random(data.shape) < gaps] = np.nan
    return pd.DataFrame(data, columns=[f"{'AbZ'[j % 3]}.{j}" for j in range(families * each)])


@pytest.mark.parametrize(
    "wide, saves",
    [
        (family_wide(1, 150, 30, 8, 0.0), True),
        (family_wide(2, 300, 30, 8, 0.003), True),
        (family_wide(3, 60, 5, 6, 0.4), False),
        (random_wide(4, 50, 40, 0.0), None),
        (random_wide(5, 12, 20, 0.3), None),
    ],
)
def test_pairs_above_a_threshold_equal_all_pairs(spark, wide, saves):
    for threshold in (0.9, 0.5):
        found = correlated_pairs(stage(long(spark, wide), "wide"), threshold, rows_per_block=64, indicators_per_block=16)
        got = {(r.a, r.b): r.r for r in found.pairs.collect()}
        want = {p: r for p, r in pandas_pairs(wide).items() if abs(r) > threshold}
        assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-5 for p in want)
        assert found.possible == wide.shape[1] * (wide.shape[1] - 1) // 2 and len(want) <= found.made <= found.possible
        if saves is not None and threshold == 0.9:
            assert (found.made < found.possible / 2) == saves


def test_pairs_above_a_threshold_of_little(spark):
    none = long(spark, pd.DataFrame({"a": [1.0, 2.0]})).limit(0)
    assert correlated_pairs(none).pairs.count() == 0
    few = pd.DataFrame({"a": [1.0, 2.0, 3.0], "b": [5.0, 5.0, 5.0], "c": [-1.0, -2.0, -3.0]})
    assert [(r.a, r.b, r.r) for r in correlated_pairs(long(spark, few)).pairs.collect()] == [("a", "c", -1.0)]


@pytest.mark.parametrize("seed", range(5))
def test_bound_on_what_gaps_can_hide(seed):
    rng = np.random.default_rng(seed)
    for _ in range(400):
        n = int(rng.integers(5, 80))
        base = rng.normal(size=n)
        x, y = base + rng.normal(scale=rng.choice([0.1, 1, 5]), size=n), base + rng.normal(scale=rng.choice([0.1, 1, 5]), size=n)
        seen = rng.random((2, n)) >= rng.choice([0, 0.02, 0.1, 0.3])
        if min(seen.sum(1)) < 2 or (both := seen[0] & seen[1]).sum() < 2:
            continue
        u, v = (np.where(s, (c - c[s].mean()) / np.sqrt(((c - c[s].mean())[s] ** 2).sum()), 0) for c, s in zip((x, y), seen))
        r = abs(np.corrcoef(x[both], y[both])[0, 1])
        peaks, counts = ((u**2).max(), (v**2).max()), (int(seen[0].sum()), int(seen[1].sum()))
        assert abs(u @ v) >= _needed(n, peaks, counts, r) - 1e-9
