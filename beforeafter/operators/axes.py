"""Principal axes fitted on reference rows and applied to both sides."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Vectors iterated beside the wanted axes: they take up what lies close behind these.
SPARE = 30
# Rows multiplied at a time, and the part of the largest variance that may be missed.
SLICE = 1_024
TOLERANCE = 1e-12


@dataclass(frozen=True)
class Axes:
    """One column of loadings per axis, largest variance first."""

    loadings: np.ndarray


def _product(rows: DataFrame, block: np.ndarray) -> np.ndarray:
    """Sum over the rows of z times (z block), by one pass.

    A task adds up a matrix of the block's shape; the matrices are added line by line,
    so neither a task nor the driver holds more than a width times a few numbers.
    """
    held = rows.sparkSession.sparkContext.broadcast(block)
    k = block.shape[1]

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros_like(held.value)
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                z = np.stack(batch["z"].iloc[at : at + SLICE].to_list())
                total += z.T @ (z @ held.value)
        yield pd.DataFrame({"line": np.arange(len(total)), **{f"c{j}": total[:, j] for j in range(k)}})

    schema = ", ".join(["line int", *(f"c{j} double" for j in range(k))])
    lines = rows.select("z").mapInPandas(partial, schema).groupBy("line").agg(*[F.sum(f"c{j}").alias(f"c{j}") for j in range(k)])
    out = np.zeros_like(block)
    for r in lines.collect():
        out[r["line"]] = r[1:]
    return out


def fit_axes(reference_rows: DataFrame, k: int = 2, max_rounds: int = 500) -> Axes:
    """Axes of the ``z`` rows, which are read once per round: stage them first.

    Block power iteration on the covariances: each round multiplies a few vectors by
    them in one distributed pass and turns the results to the best axes within their
    span (Rayleigh and Ritz). The covariances themselves are never built. Ends when
    every wanted axis is mapped onto itself to ``TOLERANCE`` of the largest variance,
    and raises if that takes more than ``max_rounds``. An axis has no natural
    direction, so each is turned until its largest loading in size is positive.
    """
    size = reference_rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("z")).alias("d")).first()
    n, d = size["n"], size["d"] or 0
    means = reference_rows.select(F.posexplode("z").alias("slot", "x")).groupBy("slot").agg(F.avg("x").alias("m"))
    centre = np.zeros(d)
    for r in means.collect():
        centre[r["slot"]] = r["m"]
    return iterate(lambda block: _product(reference_rows, block), centre, n, k, max_rounds)


def iterate(product: Callable[[np.ndarray], np.ndarray], centre: np.ndarray, n: int, k: int, max_rounds: int = 500) -> Axes:
    """The axes of ``n`` rows of mean ``centre``; ``product`` gives the sum over the rows of
    z times (z block), in one pass."""
    d = len(centre)
    if k > d:
        raise ValueError(f"{k} axes need as many indicators, there are {d}")
    block, _ = np.linalg.qr(np.random.default_rng(3).standard_normal((d, min(d, k + SPARE))))
    for _ in range(max_rounds):
        image = (product(block) - n * np.outer(centre, centre @ block)) / max(n - 1, 1)
        values, turn = np.linalg.eigh((block.T @ image + image.T @ block) / 2)
        order = np.argsort(-values)
        axes, mapped, values = block @ turn[:, order], image @ turn[:, order], values[order]
        missed = np.linalg.norm(mapped[:, :k] - axes[:, :k] * values[:k], axis=0).max()
        if missed <= TOLERANCE * max(values[0], 1e-300) or block.shape[1] == d:
            break
        block, _ = np.linalg.qr(mapped)
    else:
        raise ArithmeticError(f"axes not settled after {max_rounds} rounds: {missed / values[0]:.3g} of the variance missed")
    loadings = axes[:, :k]
    lead = loadings[np.abs(loadings).argmax(axis=0), range(k)]
    return Axes(loadings * np.where(lead < 0, -1.0, 1.0))


def project(rows: DataFrame, axes: Axes) -> DataFrame:
    """``axis_1 .. axis_k`` next to the given columns. Reference rows have mean 0
    after scaling, so nothing is subtracted."""
    loadings = axes.loadings

    @F.pandas_udf("array<double>")
    def placed(z: pd.Series) -> pd.Series:
        parts = [np.stack(z.iloc[at : at + SLICE].to_list()) @ loadings for at in range(0, len(z), SLICE)]
        return pd.Series([row for part in parts for row in part], dtype=object)

    at = rows.withColumn("at", placed("z"))
    return at.select(*rows.columns, *[F.col("at")[i].alias(f"axis_{i + 1}") for i in range(loadings.shape[1])])


def anchored(frame: DataFrame, candidates: DataFrame, high: str, low: str) -> DataFrame:
    """Flip ``axis_1`` of ``frame`` if anchor ``high`` lies below anchor ``low``
    among the candidates; without both anchors nothing changes."""
    at = {
        name: F.max(F.when(F.col("entity") == anchor, F.col("axis_1")))
        for name, anchor in (("h", high), ("l", low))
    }
    flip = (
        candidates.filter(F.col("entity").isin(high, low))
        .agg(F.when(at["h"] < at["l"], F.lit(-1.0)).otherwise(F.lit(1.0)).alias("flip"))
        .scalar()
    )
    return frame.withColumn("axis_1", F.col("axis_1") * flip)
