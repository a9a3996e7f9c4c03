"""Scaled rows as what all share plus the values that are there.

After filling and scaling, a row without a value for an indicator holds the same number
there as every other such row. A sparse row is therefore the slots of its known values
and how far each lies from that number; the numbers themselves, one per indicator, are
the ``offset`` of all rows. Axes, boundary and distances are worked out on that form, so
rows cost what they hold, not the width of the matrix. Results are those of the dense
rows, but for the order of sums.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beforeafter.functions import signed_log
from beforeafter.operators.axes import Axes, iterate
from beforeafter.operators.one_class import EDGE, FIT_ROWS, TOLERANCE, Boundary, fit_points
from beforeafter.operators.scaling import Scaling
from beforeafter.staging import broadcast_if_small

# Numbers that one step of a kernel holds at most.
STEP_NUMBERS = 1 << 21


def offset_of(scaling: Scaling) -> np.ndarray:
    """What a row holds at each slot without a value."""
    return (scaling.median - scaling.mean) / scaling.spread


def sparse_rows(long: DataFrame, scaling: Scaling, keys: Sequence[str]) -> DataFrame:
    """One row per key with ``slots`` and ``deltas``, in slot order.

    Keys without any known indicator get a row without slots. The values of a key must
    be unique per indicator; a repeated one raises. See ``scaled_rows`` for the dense form.
    """
    offset = offset_of(scaling)
    table = scaling.table(long.sparkSession)
    gaps = long.sparkSession.createDataFrame([(i, float(g)) for i, g in enumerate(offset)], "slot int, gap double")
    known = broadcast_if_small(table.join(broadcast_if_small(gaps), "slot"))
    scaled = (signed_log(F.col("value")) - F.col("mean")) / F.col("spread")
    cell = F.when(F.col("slot").isNotNull() & F.col("value").isNotNull(), F.struct("slot", (scaled - F.col("gap")).alias("delta")))
    cells = long.join(known, "indicator", "left").groupBy(*keys).agg(F.sort_array(F.collect_list(cell)).alias("cells"))
    at = F.col("cells.slot")
    unique = F.when(F.size(F.array_distinct(at)) < F.size(at), F.raise_error(F.lit("repeated key and indicator"))).otherwise(at)
    return cells.select(*keys, unique.alias("slots"), F.col("cells.delta").alias("deltas"))


def _flat(slots: pd.Series, deltas: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, slot and delta of every known value of a batch."""
    rows = np.repeat(np.arange(len(slots)), slots.map(len).to_numpy(dtype=np.int64))
    if not len(rows):
        return rows, np.zeros(0, dtype=np.int64), np.zeros(0)
    return rows, np.concatenate(slots.to_list()).astype(np.int64), np.concatenate(deltas.to_list())


def _times(slots: pd.Series, deltas: pd.Series, offset: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The rows times a matrix of few columns."""
    rows, at, delta = _flat(slots, deltas)
    out = np.tile(offset @ block, (len(slots), 1))
    np.add.at(out, rows, delta[:, None] * block[at])
    return out


def fit_axes_sparse(reference_rows: DataFrame, offset: np.ndarray, k: int = 2, max_rounds: int = 500) -> Axes:
    """``fit_axes`` on sparse rows, which are read once per round: stage them first."""
    n = reference_rows.count()
    sums = reference_rows.select(F.explode(F.arrays_zip("slots", "deltas")).alias("c")).groupBy("c.slots").agg(F.sum("c.deltas").alias("s"))
    centre = offset.copy()
    for r in sums.collect():
        centre[r["slots"]] += r["s"] / n

    def product(block: np.ndarray) -> np.ndarray:
        held = reference_rows.sparkSession.sparkContext.broadcast(block)
        width = block.shape[1]

        def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total, images = np.zeros_like(held.value), np.zeros(width)
            for batch in batches:
                image = _times(batch["slots"], batch["deltas"], offset, held.value)
                rows, at, delta = _flat(batch["slots"], batch["deltas"])
                np.add.at(total, at, delta[:, None] * image[rows])
                images += image.sum(axis=0)
            total += np.outer(offset, images)
            yield pd.DataFrame({"line": np.arange(len(total)), **{f"c{j}": total[:, j] for j in range(width)}})

        schema = ", ".join(["line int", *(f"c{j} double" for j in range(width))])
        lines = reference_rows.select("slots", "deltas").mapInPandas(partial, schema)
        summed = lines.groupBy("line").agg(*[F.sum(f"c{j}").alias(f"c{j}") for j in range(width)])
        out = np.zeros_like(block)
        for r in summed.collect():
            out[r["line"]] = r[1:]
        return out

    return iterate(product, centre, n, k, max_rounds)


def project_sparse(rows: DataFrame, axes: Axes, offset: np.ndarray) -> DataFrame:
    """``axis_1 .. axis_k`` next to the given columns; narrow, no shuffle."""
    loadings = axes.loadings

    @F.pandas_udf("array<double>")
    def placed(slots: pd.Series, deltas: pd.Series) -> pd.Series:
        return pd.Series(list(_times(slots, deltas, offset, loadings)), dtype=object)

    at = rows.withColumn("at", placed("slots", "deltas"))
    return at.select(*rows.columns, *[F.col("at")[i].alias(f"axis_{i + 1}") for i in range(loadings.shape[1])])


def _kernel_sums(
    slots: pd.Series, deltas: pd.Series, offset: np.ndarray, points: np.ndarray, weights: np.ndarray, gamma: float
) -> np.ndarray:
    """Weighted sum of each row's kernel with the points. The squared distance is that of
    the offset, changed at the known slots only."""
    rows, at, delta = _flat(slots, deltas)
    from_offset = ((offset - points) ** 2).sum(axis=1)
    own = np.bincount(rows, delta * (delta + 2 * offset[at]), len(slots))
    out = np.zeros(len(slots))
    # As many rows at a time as keep the products of their values with all points small.
    ends = np.searchsorted(rows, np.arange(len(slots) + 1))
    first = 0
    while first < len(slots):
        fits = np.searchsorted(ends, ends[first] + max(1, STEP_NUMBERS // max(1, len(points))), side="right") - 1
        last = min(len(slots), max(first + 1, fits), first + max(1, STEP_NUMBERS // max(1, len(points))))
        part = slice(ends[first], ends[last])
        cross = np.zeros((last - first, len(points)))
        np.add.at(cross, rows[part] - first, delta[part, None] * points[:, at[part]].T)
        squares = from_offset[None, :] + own[first:last, None] - 2 * cross
        out[first:last] = np.exp(-gamma * np.maximum(squares, 0.0)) @ weights
        first = last
    return out


def fit_boundary_sparse(
    reference_rows: DataFrame, offset: np.ndarray, nu: float = 0.05, gamma: float | None = None, fit_rows: int = FIT_ROWS, tol: float = TOLERANCE
) -> Boundary:
    """``fit_boundary`` on sparse rows. Above ``fit_rows`` it takes the rows with the least
    hashes of their slots and deltas. At most that many reach the driver."""
    n = reference_rows.count()
    if not n:
        raise ValueError("no reference rows")
    chosen = reference_rows.select("slots", "deltas").orderBy(F.xxhash64("slots", "deltas"), "slots", "deltas").limit(fit_rows).collect()
    points = np.tile(offset, (len(chosen), 1))
    for row, r in zip(points, chosen):
        row[r["slots"]] += r["deltas"]
    return fit_points(points, n, nu, gamma, tol)


def add_label_sparse(rows: DataFrame, boundary: Boundary, offset: np.ndarray) -> DataFrame:
    """Adds ``decision`` and ``anomaly_label`` as ``add_label`` does; narrow, no shuffle."""
    held = rows.sparkSession.sparkContext.broadcast(boundary)

    @F.pandas_udf("double")
    def decision(slots: pd.Series, deltas: pd.Series) -> pd.Series:
        b = held.value
        return pd.Series(_kernel_sums(slots, deltas, offset, b.points, b.weights, b.gamma) - b.threshold)

    decided = rows.withColumn("decision", decision("slots", "deltas"))
    return decided.withColumn("anomaly_label", F.when(F.col("decision") > EDGE, F.lit(1)).otherwise(F.lit(-1)))
