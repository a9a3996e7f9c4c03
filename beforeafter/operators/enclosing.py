"""The smallest ball around all reference rows in the kernel's space, by core sets.

Badoiu and Clarkson (2003), Tsang, Kwok and Cheung (2005): the ball of a few rows, the
core set, is solved exactly; one distributed pass finds the rows farthest from its
centre; they join the core set until none lies beyond (1 + epsilon) times its radius.
As the core's ball is no larger than that of all rows, every reference row is then
known to lie within (1 + epsilon) of the least radius possible, whatever their number,
and the core needs rows in the order of 1 / epsilon, not of the table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beforeafter.operators.one_class import EDGE, SLICE, TOLERANCE, _kernel, smallest_mean

#: Rows that join the core set in one pass at most.
BATCH = 32
#: Bins of one step when the limit of a share is narrowed down.
BINS = 4_096


@dataclass(frozen=True)
class Ball:
    """Core rows with a weight, the ``radius`` of their ball, the distance ``farthest``
    of any reference row and the ``limit`` within which a row counts as inside."""

    gamma: float
    points: np.ndarray
    weights: np.ndarray
    radius: float
    farthest: float
    limit: float
    epsilon: float
    rows_seen: int
    core_rows: int
    passes: int

    def distances(self, z: np.ndarray) -> np.ndarray:
        own = self.weights @ _kernel(self.points, self.points, self.gamma) @ self.weights
        parts = [_kernel(z[at : at + SLICE], self.points, self.gamma) @ self.weights for at in range(0, len(z), SLICE)]
        return np.sqrt(np.maximum(1.0 + own - 2.0 * np.concatenate([*parts, np.zeros(0)]), 0.0))


def add_distance(rows: DataFrame, ball: Ball) -> DataFrame:
    """Adds ``distance`` from the centre and ``anomaly_label``: 1 within the limit, else
    -1; narrow, no shuffle. The ball is broadcast: as many rows as its core."""
    held = rows.sparkSession.sparkContext.broadcast(ball)

    @F.pandas_udf("double")
    def distance(z: pd.Series) -> pd.Series:
        at = range(0, len(z), SLICE)
        parts = [held.value.distances(np.stack(z.iloc[i : i + SLICE].to_list())) for i in at]
        return pd.Series(np.concatenate([*parts, np.zeros(0)]))

    inside = F.col("distance") <= ball.limit + EDGE
    return rows.withColumn("distance", distance("z")).withColumn("anomaly_label", F.when(inside, 1).otherwise(-1))


def fit_ball(
    reference_rows: DataFrame,
    epsilon: float = 0.01,
    outside: float = 0.0,
    gamma: float | None = None,
    max_core: int = 2_000,
    tol: float = TOLERANCE,
) -> Ball:
    """Ball of rows with a ``z`` array; ``gamma`` defaults to one over its length.

    Every reference row lies within ``(1 + epsilon) * radius``, and ``radius`` is at most
    that of the smallest ball around all of them. Rows that are equally far are taken in
    order of ``z``, so the ball does not hang on their order or partitions. With
    ``outside`` above 0 the limit shrinks to the least multiple of the bin width (a
    16-millionth of the farthest distance) beyond which no larger share of the
    reference rows lies; with 0 all of them are inside. The reference rows are read once
    a pass: stage them. Only core rows reach the driver; a fit that would need more than
    ``max_core`` raises, a larger epsilon needs fewer.
    """
    size = reference_rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("z")).alias("d")).first()
    if not size["n"]:
        raise ValueError("no reference rows")
    gamma = 1.0 / size["d"] if gamma is None else gamma
    core = [reference_rows.select("z").orderBy(F.xxhash64("z"), "z").first()["z"]]
    passes = 0
    while True:
        points = np.array(core, dtype=float)
        gram = _kernel(points, points, gamma)
        weights, _ = smallest_mean(gram, 1.0, tol)
        radius = float(np.sqrt(max(1.0 - weights @ gram @ weights, 0.0)))
        used = weights > 0
        ball = Ball(gamma, points[used], weights[used], radius, np.inf, np.inf, epsilon, size["n"], len(core), passes)
        # At most BATCH rows reach the driver.
        far = add_distance(reference_rows.select("z"), ball).orderBy(F.desc("distance"), "z").limit(BATCH).collect()
        passes += 1
        held = set(map(tuple, core))
        beyond = [r["z"] for r in far if r["distance"] > (1.0 + epsilon) * radius + EDGE * (radius == 0)]
        new = [z for z in dict.fromkeys(map(tuple, beyond)) if z not in held]
        if not new:
            break
        core += new
        if len(core) > max_core:
            raise ArithmeticError(f"more than {max_core} rows in the core of {size['n']}: raise epsilon above {epsilon}")
    farthest = float(far[0]["distance"])
    limit = farthest if outside <= 0 else _limit(add_distance(reference_rows.select("z"), ball), farthest, int(outside * size["n"]))
    return Ball(gamma, ball.points, ball.weights, radius, farthest, limit, epsilon, size["n"], len(core), passes)


def _limit(measured: DataFrame, farthest: float, allowed: int) -> float:
    """The least bin edge that at most ``allowed`` distances exceed, by counting twice."""
    low, width = 0.0, farthest
    beyond_all = 0
    for step_no in range(2):
        if width <= 0:
            return farthest
        step = width / BINS
        place = F.ceil((F.col("distance") - F.lit(low)) / F.lit(step)).cast("long")
        place = F.least(place, F.lit(BINS)) if step_no == 0 else place
        part = measured.select(place.alias("bin")).filter((F.col("bin") >= 1) & (F.col("bin") <= BINS))
        # One row a bin at most.
        counts = {r["bin"]: r["count"] for r in part.groupBy("bin").count().collect()}
        beyond, at = beyond_all, BINS
        while at > 0 and beyond + counts.get(at, 0) <= allowed:
            beyond += counts.get(at, 0)
            at -= 1
        if at == 0:
            return low
        low, width, beyond_all = low + (at - 1) * step, step, beyond
    return low + width
