"""Near-duplicate vectors by an exact metric range join."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beforeafter.llm.components import connected
from beforeafter.staging import broadcast_if_small, stage

#: Rows a cell should hold, most pivots over all labels (twice that at worst), rows of
#: a block within a cell, and of a tile of two blocks that is multiplied at a time.
CELL_ROWS = 4_096
MAX_PIVOTS = 1_024
BLOCK_ROWS = 16_384
TILE_ROWS = 2_048
#: Added to angles so that rounding never loses a pair, and the band around the limit
#: in which cosines are worked out again exactly.
SLACK = 1e-6


def usable(vector: Column, label: Column) -> Column:
    """A label, and a vector of finite components, one of them not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(label.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(rows: list) -> np.ndarray:
    x = np.stack([np.asarray(r, dtype=np.float64) for r in rows])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    a, b = np.asarray(a, np.float64), np.asarray(b, np.float64)
    return math.fsum(a * b) / math.sqrt(math.fsum(a * a) * math.fsum(b * b))


def near_pairs(a: list, b: list, min_cosine: float) -> np.ndarray:
    """Matrix of which rows of ``a`` and ``b`` reach the cosine."""
    cosines = _unit(a) @ _unit(b).T
    near = cosines >= min_cosine
    for i, j in zip(*np.nonzero(np.abs(cosines - min_cosine) < 1e-12 + 1e-15 * len(a[0]))):
        near[i, j] = exact_cosine(a[i], b[j]) >= min_cosine
    return near


def _pivots(classes: DataFrame) -> dict:
    """Pivot matrices by label and length of vector, for those worth dividing."""
    sizes = stage(classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("rows")), "vector-sizes")
    total = sizes.agg(F.sum("rows")).first()[0] or 0
    rows = max(CELL_ROWS, -(-total // MAX_PIVOTS))
    wanted = sizes.filter(F.col("rows") > rows).withColumn("pivots", F.ceil(F.col("rows") / rows))
    # Twice as many as wanted by a hash threshold, then the first of these: bounded.
    drawn = (
        classes.withColumn("_h", F.pmod(F.xxhash64("vector", F.lit(3)), F.lit(1 << 40)))
        .join(broadcast_if_small(wanted), ["label", "dim"])
        .filter(F.col("_h") * F.col("rows") < F.col("pivots") * F.lit(2.0 * (1 << 40)))
    )
    place = F.row_number().over(Window.partitionBy("label", "dim").orderBy("_h", "cid"))
    found: dict = {}
    for r in drawn.withColumn("_n", place).filter("_n <= pivots").select("label", "dim", "_n", "vector").collect():
        found.setdefault((r["label"], r["dim"]), []).append((r["_n"], r["vector"]))
    return {key: _unit([v for _, v in sorted(rows, key=lambda x: x[0])]) for key, rows in found.items()}


def _located(classes: DataFrame, radius: float) -> DataFrame:
    """Each class with its ``home`` cell and the ``cells`` it is needed in.

    Home is the nearest pivot. If x lies in cell p and y in cell q > p within the
    radius r of each other, then by the triangle inequality y is at most 2 r farther
    from p than from q; so y is copied to every lower cell within that margin.
    """
    pivots = classes.sparkSession.sparkContext.broadcast(_pivots(classes))

    @F.pandas_udf("home int, cells array<int>")
    def locate(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for labels, dims, vectors in batches:
            home, cells = [0] * len(labels), [[0]] * len(labels)
            groups = pd.Series(range(len(labels))).groupby([labels.to_numpy(), dims.to_numpy()], sort=False).indices
            for key, at in groups.items():
                centres = pivots.value.get((key[0], int(key[1])))
                if centres is None:
                    continue
                angles = np.arccos(np.clip(_unit([vectors.iloc[i] for i in at]) @ centres.T, -1.0, 1.0))
                nearest = angles.argmin(axis=1)
                margin = angles.min(axis=1) + 2.0 * radius + SLACK
                for i, row, h, m in zip(at, angles, nearest, margin):
                    home[i], cells[i] = int(h), [*np.flatnonzero(row[:h] <= m).tolist(), int(h)]
            yield pd.DataFrame({"home": home, "cells": cells})

    return classes.withColumn("_at", locate("label", "dim", "vector"))


def _local_roots(near: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least class reachable inside the unit, for both sides."""
    far = np.iinfo(np.int64).max
    while True:
        a = np.minimum(left, np.where(near, right[None, :], far).min(axis=1, initial=far))
        b = np.minimum(right, np.where(near, a[:, None], far).min(axis=0, initial=far))
        if (a == left).all() and (b == right).all():
            return a, b
        left, right = a, b


def _tile_links(a: pd.DataFrame, b: pd.DataFrame, same: bool, min_cosine: float) -> list[pd.DataFrame]:
    """Links between two tiles, or inside one, summed up per class."""
    near = near_pairs(a["vector"].tolist(), b["vector"].tolist(), min_cosine)
    near &= a["native"].to_numpy()[:, None] | b["native"].to_numpy()[None, :]
    if same:
        np.fill_diagonal(near, False)
    rows, cols = near.any(axis=1), near.any(axis=0)
    if not rows.any():
        return []
    a, b, near = a[rows], b[cols], near[np.ix_(rows, cols)]
    roots = _local_roots(near, a["cid"].to_numpy(), b["cid"].to_numpy())
    out = [pd.DataFrame({"cid": a["cid"].to_numpy(), "linked": near @ b["n"].to_numpy(), "root": roots[0]})]
    if not same:
        out.append(pd.DataFrame({"cid": b["cid"].to_numpy(), "linked": a["n"].to_numpy() @ near, "root": roots[1]}))
    return out


def _unit_links(min_cosine: float):
    """Links inside one pair of blocks of one cell, tile by tile."""

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
        a = pdf[pdf["block"] == i].sort_values("cid")
        b = a if i == j else pdf[pdf["block"] == j].sort_values("cid")
        out = [pd.DataFrame({"cid": [], "linked": [], "root": []})]
        for x in range(0, len(a), TILE_ROWS):
            for y in range(x if i == j else 0, len(b), TILE_ROWS):
                out += _tile_links(a.iloc[x : x + TILE_ROWS], b.iloc[y : y + TILE_ROWS], i == j and x == y, min_cosine)
        return pd.concat(out).astype("int64")

    return links


def classes_of(
    df: DataFrame, min_cosine: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """One row per row: id, ``n_links``, ``component_id`` and ``kept``.

    Rows are linked if their labels are equal and not null, their vectors have the same
    length and the cosine, in double precision, is at least ``min_cosine``; a row does
    not count itself. Null vectors, and those with null or non-finite components or
    none but zeros, link with nothing. Equal vectors of a label are compared once, as
    one class with a count. Cells too full for one task are cut into blocks, and each
    pair of blocks is a task of bounded size; it hands on one row per class with its
    number of links and the least class it reaches, never the pairs. ``component_id``
    is the least id reachable by links, ``kept`` whether it is the row's own. Repeated
    rows count each; null ids count last; an empty table stays empty.
    """
    vector, label = F.col(f"`{vector_col}`"), F.col(f"`{label_col}`")
    rows = stage(
        df.select(
            F.col(f"`{id_col}`").alias("id"),
            F.when(usable(vector, label), label).alias("label"),
            F.when(usable(vector, label), vector).alias("vector"),
            F.monotonically_increasing_id().alias("uid"),
        ),
        "vectors",
    )
    classes = rows.filter("vector IS NOT NULL").groupBy("label", "vector").agg(
        F.min("uid").alias("cid"), F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")
    )
    classes = stage(classes.withColumn("dim", F.size("vector")), "vector-classes")
    located = _located(classes, math.acos(min_cosine))
    placed = stage(
        located.select("cid", "n", "label", "dim", "vector", F.col("_at")["home"].alias("home"), F.explode("_at.cells").alias("cell")),
        "vector-cells",
    )
    full = placed.groupBy("label", "dim", "cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("blocks"))
    block = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1))
    units = (
        placed.join(broadcast_if_small(full), ["label", "dim", "cell"])
        .select("*", block.alias("block"), (F.col("home") == F.col("cell")).alias("native"))
        .select("*", other.alias("_other"))
        .withColumn("i", F.least("block", "_other"))
        .withColumn("j", F.greatest("block", "_other"))
    )
    found = units.select("label", "dim", "cell", "i", "j", "block", "native", "cid", "n", "vector").groupBy(
        "label", "dim", "cell", "i", "j"
    ).applyInPandas(_unit_links(min_cosine), "cid long, linked long, root long")
    found = stage(found, "vector-links")
    linked = found.groupBy("cid").agg(F.sum("linked").alias("linked"))
    roots = connected(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    table = (
        classes.join(linked, "cid", "left")
        .join(roots, F.col("cid") == F.col("node"), "left")
        .select("label", "vector", "rep", F.coalesce("root", "cid").alias("root"), (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    )
    table = stage(table, "vector-table")
    heads = table.groupBy("root").agg(F.min("rep").alias("component_id"))
    table = table.join(heads, "root").select(
        F.col("label").alias("_l"), F.col("vector").alias("_v"), "n_links", "component_id"
    )
    joined = rows.join(table, (F.col("label") == F.col("_l")) & (F.col("vector") == F.col("_v")), "left")
    alone = F.col("_v").isNull()
    component = F.when(alone, F.col("id")).otherwise(F.col("component_id"))
    return joined.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
