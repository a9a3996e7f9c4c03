"""One-class boundary around reference rows (Schoelkopf et al. 2001, RBF kernel).

The problem: minimise half the squared length of a weighted mean of the mapped
reference rows, weights at most 1/(nu n). A row scores its product with that
mean less a threshold; above zero it is an inlier (label 1), else -1.

There is one algorithm at every size: the kernel itself on at most ``fit_rows``
reference rows, those with the least hashes of their values; the rest of the
reference rows only count. Candidates are scored where they lie.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Reference rows a fit uses at most: its kernel matrix has the square of that.
FIT_ROWS = 1_000
# Largest gap of optimality a fit may end with.
TOLERANCE = 1e-12
# Rows on the boundary itself, such as copies of most fitted rows with a weight, score
# zero but for rounding; within this they count as outside.
EDGE = 1e-9
# Rows whose kernel is worked out at a time.
SLICE = 1_024


@dataclass(frozen=True)
class Boundary:
    """Reference rows with a weight, the weights, and how the fit went: ``rows_seen``
    reference rows, of which ``rows_used`` were fitted, to a ``gap`` of optimality."""

    gamma: float
    points: np.ndarray
    weights: np.ndarray
    threshold: float
    gap: float
    rows_seen: int
    rows_used: int

    def values(self, z: np.ndarray) -> np.ndarray:
        parts = [_kernel(z[at : at + SLICE], self.points, self.gamma) @ self.weights for at in range(0, len(z), SLICE)]
        return np.concatenate([*parts, np.zeros(0)]) - self.threshold


def _kernel(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    squares = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * a @ b.T
    return np.exp(-gamma * np.maximum(squares, 0.0))


def smallest_mean(
    gram: np.ndarray, cap: float, tol: float = TOLERANCE, max_steps: int = 1_000_000
) -> tuple[np.ndarray, float]:
    """Weights in [0, cap] summing to 1 with the shortest weighted mean, and what is
    left of the optimality gap. Each step moves weight between the worst pair. Raises
    if the gap is not down to ``tol`` in ``max_steps``."""
    n = len(gram)
    alpha = np.full(n, 1.0 / n)
    grad = gram @ alpha
    tiny = 1e-14
    gap = np.inf
    for _ in range(max_steps):
        up = np.where(alpha < cap - tiny, grad, np.inf)
        down = np.where(alpha > tiny, grad, -np.inf)
        i, j = int(up.argmin()), int(down.argmax())
        gap = down[j] - up[i]
        if gap <= tol:
            return alpha, float(max(gap, 0.0))
        curve = max(gram[i, i] + gram[j, j] - 2.0 * gram[i, j], 1e-15)
        step = min(gap / curve, cap - alpha[i], alpha[j])
        alpha[i] += step
        alpha[j] -= step
        grad += step * (gram[:, i] - gram[:, j])
    raise ArithmeticError(f"boundary not settled after {max_steps} steps: gap {gap:.3g}, tolerance {tol:.3g}")


def fit_boundary(
    reference_rows: DataFrame, nu: float = 0.05, gamma: float | None = None, fit_rows: int = FIT_ROWS, tol: float = TOLERANCE
) -> Boundary:
    """Boundary of rows with a ``z`` array; ``gamma`` defaults to one over its length.

    Above ``fit_rows`` rows the fit takes those with the least hashes of ``z`` (ties by
    ``z`` itself): the same rows whatever their order or partitions.
    """
    size = reference_rows.agg(F.count(F.lit(1)).alias("n")).first()
    if not size["n"]:
        raise ValueError("no reference rows")
    # At most fit_rows rows reach the driver.
    chosen = reference_rows.select("z").orderBy(F.xxhash64("z"), "z").limit(fit_rows).collect()
    return fit_points(np.array([r["z"] for r in chosen], dtype=float), size["n"], nu, gamma, tol)


def fit_points(points: np.ndarray, rows_seen: int, nu: float, gamma: float | None, tol: float) -> Boundary:
    """The boundary of rows on the driver, chosen from ``rows_seen``."""
    n = len(points)
    gamma = 1.0 / points.shape[1] if gamma is None else gamma
    gram = _kernel(points, points, gamma)
    cap = 1.0 / (nu * n)
    alpha, gap = smallest_mean(gram, cap, tol)
    scores = gram @ alpha
    free = (alpha > cap * 1e-8) & (alpha < cap * (1 - 1e-8))
    if free.any():
        threshold = scores[free].mean()
    else:
        full, none = scores[alpha >= cap * (1 - 1e-8)], scores[alpha <= cap * 1e-8]
        ends = [e for e in (full.max() if len(full) else None, none.min() if len(none) else None) if e is not None]
        threshold = float(np.mean(ends))
    used = alpha > 0
    return Boundary(gamma, points[used], alpha[used], float(threshold), gap, rows_seen, n)


def add_label(rows: DataFrame, boundary: Boundary) -> DataFrame:
    """Adds ``decision`` and ``anomaly_label`` (1 inside, -1 outside or
    on the boundary); narrow, no shuffle.

    The boundary is broadcast: at most ``fit_rows`` rows, checked by the fit."""
    held = rows.sparkSession.sparkContext.broadcast(boundary)

    @F.pandas_udf("double")
    def decision(z: pd.Series) -> pd.Series:
        at = range(0, len(z), SLICE)
        parts = [held.value.values(np.stack(z.iloc[i : i + SLICE].to_list())) for i in at]
        return pd.Series(np.concatenate([*parts, np.zeros(0)]))

    return rows.withColumn("decision", decision("z")).withColumn(
        "anomaly_label", F.when(F.col("decision") > EDGE, F.lit(1)).otherwise(F.lit(-1))
    )
