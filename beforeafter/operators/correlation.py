"""Pairwise correlation of indicators over (entity, event) rows, and the filter on it.

The pairs of one row are never listed. Rows and indicators are hashed into
blocks; for each pair of indicator blocks a task multiplies two small matrices per
block of rows and adds the products up, so that it hands on one partial sum per
indicator pair, however many blocks of rows it read. A plain aggregate adds up the
partial sums of the few tasks that share a pair of blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beforeafter.schema import EVENT_KEYS
from beforeafter.staging import broadcast_if_small, stage, stage_side

# Below this share of the sum of squares a variance is rounding noise.
FLAT = 1e-12
# |r| has to pass the threshold by more than rounding noise.
NOISE = 1e-12

_MOMENTS = ("n", "sa", "sb", "saa", "sbb", "sab")
_PARTIAL = "a string, b string, " + ", ".join(f"{m} double" for m in _MOMENTS)


def _standardised(features: DataFrame) -> DataFrame:
    """Values as deviations from the indicator's mean in units of its spread.

    Correlation does not change, but the sums below stay free of cancellation.
    Constant indicators have no correlation and are left out.
    """
    stats = (
        features.groupBy("indicator")
        .agg(
            F.avg("avg_value").alias("m"),
            F.stddev_pop("avg_value").alias("s"),
            F.min("avg_value").alias("lo"),
            F.max("avg_value").alias("hi"),
        )
        .filter((F.col("lo") < F.col("hi")) & (F.col("s") > 0))
    )
    return (
        features.dropna(subset=["avg_value"])
        .join(stage_side(stats, "spreads"), "indicator")
        .select(*EVENT_KEYS, "indicator", ((F.col("avg_value") - F.col("m")) / F.col("s")).alias("z"))
    )


def _matrix(cells: pd.DataFrame, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes, cols = np.unique(cells["indicator"].to_numpy(dtype=object), return_inverse=True)
    z = np.zeros((n_rows, len(codes)))
    seen = np.zeros((n_rows, len(codes)))
    z[rows, cols] = cells["z"].to_numpy()
    seen[rows, cols] = 1.0
    return codes, z, seen


class _Sums:
    """Moments of every indicator pair between two blocks, added up over blocks of rows."""

    def __init__(self) -> None:
        self.places: tuple[dict[str, int], dict[str, int]] = ({}, {})
        self.total = np.zeros((len(_MOMENTS), 0, 0))

    def add(self, cells: pd.DataFrame) -> None:
        """One block of rows, whole."""
        entity, _ = pd.factorize(cells["entity"])
        at, ats = pd.factorize(cells["event_at"])
        rows, names = pd.factorize(entity.astype(np.int64) * len(ats) + at)
        left = (cells["side"] == cells["bi"]).to_numpy()
        right = (cells["side"] == cells["bj"]).to_numpy()
        codes_a, za, ma = _matrix(cells[left], rows[left], len(names))
        codes_b, zb, mb = _matrix(cells[right], rows[right], len(names))
        a, b = ([p.setdefault(c, len(p)) for c in codes] for p, codes in zip(self.places, (codes_a, codes_b)))
        known = self.total
        self.total = np.zeros((len(_MOMENTS), *map(len, self.places)))
        self.total[:, : known.shape[1], : known.shape[2]] = known
        products = (ma.T @ mb, za.T @ mb, ma.T @ zb, (za * za).T @ mb, ma.T @ (zb * zb), za.T @ zb)
        for total, product in zip(self.total, products):
            total[np.ix_(a, b)] += product

    def pairs(self, same: bool) -> pd.DataFrame:
        codes_a, codes_b = (np.array(list(p), dtype=object) for p in self.places)
        out = pd.DataFrame(
            {
                "a": np.repeat(codes_a, len(codes_b)),
                "b": np.tile(codes_b, len(codes_a)),
                **{m: t.ravel() for m, t in zip(_MOMENTS, self.total)},
            }
        )
        return out[(out["a"] < out["b"]) & (out["n"] > 0)] if same else _ordered(out[out["n"] > 0])


def _summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pair sums of rows that come sorted by ``bi, bj, salt, rb``; holds one block of rows
    and the sums of one pair of blocks at a time."""
    block: list[pd.DataFrame] = []
    key: tuple | None = None
    sums = _Sums()
    for batch in batches:
        if not len(batch):
            continue
        keys = batch[["bi", "bj", "salt", "rb"]].to_numpy()
        starts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(batch)]
        for first, last in zip(starts, starts[1:]):
            now = tuple(keys[first])
            if key is not None and now != key:
                sums.add(pd.concat(block))
                block = []
                if now[:3] != key[:3]:
                    yield sums.pairs(key[0] == key[1])
                    sums = _Sums()
            key = now
            block.append(batch.iloc[first:last])
    if block:
        sums.add(pd.concat(block))
        yield sums.pairs(key[0] == key[1])


def _ordered(pairs: pd.DataFrame) -> pd.DataFrame:
    """The smaller code first, with its moments."""
    swap = (pairs["a"] > pairs["b"]).to_numpy()
    out = pairs.copy()
    for x, y in (("a", "b"), ("sa", "sb"), ("saa", "sbb")):
        out[x] = np.where(swap, pairs[y], pairs[x])
        out[y] = np.where(swap, pairs[x], pairs[y])
    return out


def correlation_pairs(
    features: DataFrame,
    rows_per_block: int = 2048,
    indicators_per_block: int = 256,
) -> DataFrame:
    """Pearson correlation of every indicator pair ``a < b`` on the rows that have both.

    Pairs sharing fewer than two rows, or constant on the rows they share, have
    none and are left out. ``features`` is read three times: stage what is behind it.
    """
    z = _standardised(features)
    # Only block counts hang on these estimates, no result does.
    size = features.agg(
        F.approx_count_distinct(F.struct(*EVENT_KEYS)).alias("rows"),
        F.approx_count_distinct("indicator").alias("codes"),
    ).first()
    n_rb = max(1, -(-size["rows"] // rows_per_block))
    n_cb = max(1, -(-size["codes"] // indicators_per_block))
    # A block of indicators takes part in one product with every block, itself included.
    placed = z.withColumn("side", F.pmod(F.xxhash64("indicator"), F.lit(n_cb)).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.lit(n_cb - 1)))
    )
    return _correlations(_pair_sums(placed, n_rb, n_cb * (n_cb + 1) // 2))


def _pair_sums(placed: DataFrame, n_rb: int, n_products: int) -> DataFrame:
    """Moments of every indicator pair whose blocks meet: cells come once for each block
    (``other``) that theirs (``side``) is multiplied with; ``n_products`` such pairs."""
    placed = (
        placed.withColumn("rb", F.pmod(F.xxhash64(*EVENT_KEYS), F.lit(n_rb)).cast("int"))
        .withColumn("bi", F.least("side", "other"))
        .withColumn("bj", F.greatest("side", "other"))
        .drop("other")
    )
    # As many tasks as the session wants, several to a pair of blocks where these are few.
    n_tasks = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = min(n_rb, -(-n_tasks // n_products))
    blocks = placed.withColumn("salt", F.pmod("rb", F.lit(salts))).repartition(n_tasks, "bi", "bj", "salt")
    partial = blocks.sortWithinPartitions("bi", "bj", "salt", "rb").mapInPandas(_summed, _PARTIAL)
    return partial.groupBy("a", "b").agg(*[F.sum(m).alias(m) for m in _MOMENTS])


def _correlations(sums: DataFrame) -> DataFrame:
    var_a = F.col("n") * F.col("saa") - F.col("sa") * F.col("sa")
    var_b = F.col("n") * F.col("sbb") - F.col("sb") * F.col("sb")
    covar = F.col("n") * F.col("sab") - F.col("sa") * F.col("sb")
    varies = (var_a > FLAT * F.col("n") * F.col("saa")) & (var_b > FLAT * F.col("n") * F.col("sbb"))
    return (
        sums.filter((F.col("n") >= 2) & varies)
        .select(
            "a",
            "b",
            F.col("n").cast("long").alias("n_rows"),
            F.greatest(F.lit(-1.0), F.least(F.lit(1.0), covar / F.sqrt(var_a) / F.sqrt(var_b))).alias("r"),
        )
    )


@dataclass(frozen=True)
class Correlated:
    """Pairs above a threshold, and how many were worked out (``made``) after each
    indicator had met the leaders (``led`` pairs), of all ``possible`` ones."""

    pairs: DataFrame
    made: int
    led: int
    possible: int


def correlated_pairs(
    features: DataFrame,
    threshold: float = 0.9,
    rows_per_block: int = 2048,
    indicators_per_block: int = 256,
    max_leaders: int = 64,
) -> Correlated:
    """The pairs of ``correlation_pairs`` with ``|r|`` above the threshold, without working
    out those that cannot be.

    An indicator is a direction in the space of rows, gaps counting as zero. Each joins
    the nearest of some leaders, those with the least hashes of their codes, and a group
    knows its greatest angle to its leader. Two groups whose leaders lie further apart
    than both angles and the angle of the threshold hold no pair above it and never
    meet. Correlation is taken over the rows that both have, so the threshold for angles
    is lowered by what the gaps can hide (``_needed``): indicators with many gaps meet
    all others. Directions and their opposites are one. The result is exact; what is
    saved hangs on the data: a lot where indicators come in families, nothing where all
    are at right angles or full of gaps.

    Angles to leaders cost indicators times leaders products, in blocks as above. One
    figure a group and pair of groups is on the driver, at most ``max_leaders`` squared.
    """
    z = stage(_standardised(features), "standardised")
    per_code = stage(
        z.groupBy("indicator").agg(F.count(F.lit(1)).alias("n"), (F.max(F.abs("z")) ** 2 / F.count(F.lit(1))).alias("peak")), "codes"
    )
    n_codes = per_code.count()
    n_rows = z.select(*EVENT_KEYS).distinct().count()
    n_rb = max(1, -(-n_rows // rows_per_block))
    n_cb = max(1, -(-n_codes // indicators_per_block))
    n_leaders = min(max_leaders, max(1, 4 * math.isqrt(n_codes)))
    chosen = per_code.orderBy(F.xxhash64("indicator"), "indicator").limit(n_leaders).collect()
    leaders = {r["indicator"]: i for i, r in enumerate(chosen)}
    table = z.sparkSession.createDataFrame(list(leaders.items()) or [("", 0)], "indicator string, leader int")

    # Leaders are block 0 and meet all blocks, under names that sort behind the codes':
    # as indicators they have a block too.
    block = F.pmod(F.xxhash64("indicator"), F.lit(n_cb)).cast("int") + 1
    plain = z.withColumns({"side": block, "other": F.lit(0), "indicator": F.concat(F.lit("c"), "indicator")})
    # One row for each of at most max_leaders, so the table has a bounded size.
    led = z.join(F.broadcast(table), "indicator").withColumns({"side": F.lit(0), "indicator": F.concat(F.lit("l"), F.col("leader"))})
    led = led.withColumn("other", F.explode(F.sequence(F.lit(1), F.lit(n_cb)))).drop("leader")
    sums = _pair_sums(plain.unionByName(led), n_rb, n_cb)
    own = per_code.select("indicator", "n", "peak")
    n_of = F.create_map(*[F.lit(x) for r in chosen for x in (leaders[r["indicator"]], r["n"])]) if chosen else F.lit(None).cast("map<int,bigint>")
    angled = sums.select(
        F.substring("a", F.lit(2), F.length("a")).alias("indicator"), F.substring("b", F.lit(2), F.length("b")).cast("int").alias("leader"), "sab"
    ).join(own, "indicator")
    cosine = F.least(F.lit(1.0), F.abs("sab") / F.sqrt(F.col("n") * F.element_at(n_of, F.col("leader"))))
    angled = stage(angled.select("indicator", "leader", F.acos(cosine).alias("angle")), "angles")
    nearest = angled.groupBy("indicator").agg(F.min(F.struct("angle", "leader")).alias("best"))
    grouped = own.join(nearest, "indicator", "left").join(F.broadcast(table), "indicator", "left")
    # A leader is its own nearest; without any row shared with a leader an indicator stands
    # at a right angle to all of them.
    grouped = grouped.select(
        "indicator", "n", "peak",
        F.coalesce("leader", F.col("best")["leader"], F.lit(0)).alias("group"),
        F.when(F.col("leader").isNotNull(), 0.0).otherwise(F.coalesce(F.col("best")["angle"], F.lit(math.pi / 2))).alias("angle"),
    )
    grouped = stage(grouped, "groups")
    groups = {
        r["group"]: r for r in grouped.groupBy("group").agg(
            F.count(F.lit(1)).alias("codes"), F.max("angle").alias("radius"), F.max("peak").alias("peak"), F.min("n").alias("n")
        ).collect()
    }
    apart = {}
    for r in angled.join(F.broadcast(table.withColumnRenamed("leader", "from")), "indicator").select("from", "leader", "angle").collect():
        apart[r["from"], r["leader"]] = r["angle"]
    meets = [(g, h) for g in groups for h in groups if g <= h and _can_meet(groups[g], groups[h], apart.get((g, h), math.pi / 2), n_rows, threshold)]

    # Blocks of a group are numbered behind those of the groups before it.
    first, blocks = {}, 0
    for g, r in sorted(groups.items()):
        first[g], blocks = blocks, blocks + -(-r["codes"] // indicators_per_block)
    many = {g: -(-r["codes"] // indicators_per_block) for g, r in groups.items()}
    partners: dict[int, list[int]] = {g: [] for g in groups}
    for g, h in meets:
        partners[g] += range(first[h], first[h] + many[h])
        if g != h:
            partners[h] += range(first[g], first[g] + many[g])
    rows = [(g, first[g], many[g], sorted(partners[g])) for g in groups]
    dealt = z.sparkSession.createDataFrame(rows or [(0, 0, 1, [0])], "group int, first int, many int, others array<int>")
    placed = (
        z.join(broadcast_if_small(grouped.select("indicator", "group")), "indicator")
        .join(F.broadcast(dealt), "group")
        .withColumn("side", F.col("first") + F.pmod(F.xxhash64("indicator"), F.col("many")).cast("int"))
        .withColumn("other", F.explode("others"))
        .select(*EVENT_KEYS, "indicator", "z", "side", "other")
    )
    n_products = sum(many[g] * (many[g] + 1) // 2 if g == h else many[g] * many[h] for g, h in meets)
    pairs = _correlations(_pair_sums(placed, n_rb, max(1, n_products))).filter(F.abs("r") > threshold + NOISE)
    codes = {g: r["codes"] for g, r in groups.items()}
    made = sum(codes[g] * (codes[g] - 1) // 2 if g == h else codes[g] * codes[h] for g, h in meets)
    return Correlated(pairs, made, n_codes * len(chosen), n_codes * (n_codes - 1) // 2)


def _needed(n_rows: int, peaks: tuple[float, float], counts: tuple[int, int], threshold: float) -> float:
    """The least cosine of two directions that may hide a correlation above the threshold.

    ``counts`` are the least numbers of values and ``peaks`` the greatest shares of a
    direction's square in one row. Rows that only one indicator has are at most as many
    as the other's gaps; they hold at most that many peaks of its square, which bounds
    how far mean, spread and product over the shared rows lie from those over all.
    """
    gaps = n_rows - counts[0], n_rows - counts[1]
    shared = n_rows - gaps[0] - gaps[1]
    lost = min(1.0, gaps[1] * peaks[0]), min(1.0, gaps[0] * peaks[1])
    if shared <= 0:
        return 0.0
    left = 1.0 - lost[0] * (1 + gaps[1] / shared), 1.0 - lost[1] * (1 + gaps[0] / shared)
    if min(left) <= 0:
        return 0.0
    return threshold * math.sqrt(left[0] * left[1]) - math.sqrt(gaps[0] * gaps[1] * lost[0] * lost[1]) / shared


def _can_meet(g, h, apart: float, n_rows: int, threshold: float) -> bool:
    if g["group"] == h["group"]:
        return True
    needed = _needed(n_rows, (g["peak"], h["peak"]), (g["n"], h["n"]), threshold)
    # An edge for rounding: angles come from sums of products.
    return needed <= 0 or apart - g["radius"] - h["radius"] <= math.acos(min(1.0, needed)) + 1e-6


def correlated_later(pairs: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Indicators correlated above the threshold with one that sorts before them.

    An earlier indicator counts even if it is dropped itself.
    """
    return (
        pairs.filter(F.abs("r") > threshold + NOISE).select(F.col("b").alias("indicator")).distinct()
    )
