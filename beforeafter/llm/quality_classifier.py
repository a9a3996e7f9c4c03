"""Quality by voting of the nearest labelled documents in a latent-semantic space."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells that words are hashed into, then cells for the shape of a text.
WORD_CELLS = 4_000
#: Upper ends of the classes that each figure on a text's shape falls into.
SHAPE = {
    "words": (8, 16, 32, 64, 128, 256, 512, 1024, 2048, 4096, 8192),
    "word_bytes": (2.0, 3.0, 3.5, 4.0, 4.5, 5.0, 5.5, 6.0, 6.5, 7.0, 7.5, 8.0, 9.0, 10.0, 12.0),
    "symbols_per_word": (0.0, 0.02, 0.05, 0.1, 0.3, 1.0, 2.0),
    "shouts_per_word": (0.0, 0.05, 0.1, 0.3, 0.7),
    "digits_per_byte": (0.0, 0.02, 0.1, 0.3),
    "capitals_per_byte": (0.02, 0.05, 0.1, 0.2, 0.4, 0.6),
    "distinct_share": (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9),
    "top_word_share": (0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.8),
}
CELLS = WORD_CELLS + sum(len(ends) + 1 for ends in SHAPE.values())
#: Labelled rows that a fit reads at most, taken by the least hash of their id.
SAMPLE_ROWS = 4_000
DIMENSIONS = 64
NEIGHBOURS = 25
#: Documents multiplied with all labelled vectors at a time.
BLOCK = 256

_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)


def counts(text: str | None) -> np.ndarray | None:
    """Logarithms of word counts by hashed cell, then a one for each class of shape;
    None for a text without words."""
    data = (text or "").encode()
    words = data.lower().split()
    if not words:
        return None
    cells = np.bincount([zlib.crc32(w) % WORD_CELLS for w in words], minlength=WORD_CELLS)
    row = np.zeros(CELLS, dtype=np.float32)
    row[:WORD_CELLS] = np.log1p(cells)
    by_byte, n = np.bincount(np.frombuffer(data, np.uint8), minlength=256), len(words)
    figures = {
        "words": n,
        "word_bytes": sum(map(len, words)) / n,
        "symbols_per_word": by_byte[_SYMBOLS].sum() / n,
        "shouts_per_word": by_byte[33] / n,
        "digits_per_byte": by_byte[48:58].sum() / len(data),
        "capitals_per_byte": by_byte[65:91].sum() / len(data),
        "distinct_share": len(set(words)) / n,
        "top_word_share": cells.max() / n,
    }
    at = WORD_CELLS
    for name, ends in SHAPE.items():
        row[at + int(np.searchsorted(ends, figures[name]))] = 1.0
        at += len(ends) + 1
    return row


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def weighed(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted counts, with words and shape of length one each."""
    x = rows * weights
    return np.hstack([_unit(x[:, :WORD_CELLS]), _unit(x[:, WORD_CELLS:])])


@dataclass(frozen=True)
class Voters:
    """``weights`` of the cells, ``axes`` of the latent space (cells by dimensions), and
    the labelled vectors, of length one, with their labels."""

    weights: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def latent(self, rows: np.ndarray) -> np.ndarray:
        return _unit(weighed(rows, self.weights) @ self.axes)

    def votes(self, rows: np.ndarray) -> np.ndarray:
        """Mean label of the nearest labelled vectors, weighed by their cosine."""
        cosines = self.latent(rows) @ self.vectors.T
        k = min(NEIGHBOURS, cosines.shape[1])
        if not k:
            return np.zeros(len(rows))
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosines, near, axis=1), 0.0).astype(float)
        total = weight.sum(axis=1)
        return np.where(total > 0, (weight * self.labels[near]).sum(axis=1) / np.where(total > 0, total, 1.0), 0.0)

    def scores(self, texts: pd.Series) -> np.ndarray:
        out = np.zeros(len(texts))
        for at in range(0, len(texts), BLOCK):
            rows = [counts(t) for t in texts.iloc[at : at + BLOCK]]
            full = [i for i, r in enumerate(rows) if r is not None]
            if full:
                out[[at + i for i in full]] = self.votes(np.stack([rows[i] for i in full]))
        return np.clip(out, 0.0, 1.0)


def _leading_axes(x: np.ndarray, k: int, seed: int = 5, rounds: int = 6) -> np.ndarray:
    """Leading right singular vectors by seeded block power iteration."""
    k = min(k, *x.shape)
    block = np.random.default_rng(seed).standard_normal((x.shape[1], min(k + 16, *x.shape))).astype(np.float32)
    for _ in range(rounds):
        block, _ = np.linalg.qr(x.T @ (x @ block))
    _, _, turn = np.linalg.svd(x @ block, full_matrices=False)
    return (block @ turn.T[:, :k]).astype(np.float32)


def held_out(doc_id: Column) -> Column:
    """Rows kept for testing: crc32 of the id as text leaves 2 when divided by 4.
    A null id is not one of them."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Voters:
    """Voters from labelled documents that are not held out.

    At most ``SAMPLE_ROWS`` labelled ids, those with the least hashes, are looked up in
    the documents, the least text of each; their counts (as many floats a row as a text has different words,
    ``CELLS`` at most) come to the driver, where the axes are fitted. Labels other than
    0 and 1, null ids, and texts without words teach nothing. Without any labelled
    text every score is 0.
    """
    key, label = F.col(f"`{id_col}`"), F.col(f"`{label_col}`")
    chosen = labels.filter(key.isNotNull() & ~held_out(key) & label.isin(0, 1)).select(
        key.alias("_id"), label.cast("int").alias("_label")
    ).orderBy(F.xxhash64("_id", F.lit(11)), "_id", "_label").limit(SAMPLE_ROWS)

    @F.pandas_udf("cells array<int>, values array<float>")
    def sparse(texts: pd.Series) -> pd.DataFrame:
        rows = [counts(t) for t in texts]
        cells = [None if r is None else np.flatnonzero(r) for r in rows]
        return pd.DataFrame({"cells": cells, "values": [None if c is None else r[c] for c, r in zip(cells, rows)]})

    # Of bounded size: SAMPLE_ROWS ids, and one text for each, the least, before they are
    # read: an id may be that of any share of the documents.
    ids = chosen.select("_id").distinct()
    texts = documents.select(key.alias("_key"), F.col(f"`{text_col}`").alias("_text")).join(
        F.broadcast(ids), F.col("_key") == F.col("_id"), "left_semi"
    ).groupBy("_key").agg(F.min("_text").alias("_text"))
    taught = texts.join(F.broadcast(chosen), F.col("_key") == F.col("_id"))
    rows = [
        r for r in taught.select("_id", "_label", sparse("_text").alias("c")).collect() if r["c"]["cells"] is not None
    ]
    rows.sort(key=lambda r: (zlib.crc32(str(r["_id"]).encode()), r["_id"], r["_label"], r["c"]["cells"]))
    if not rows:
        return Voters(np.ones(CELLS, np.float32), np.zeros((CELLS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0))
    x = np.zeros((len(rows), CELLS), dtype=np.float32)
    for i, r in enumerate(rows):
        x[i, r["c"]["cells"]] = r["c"]["values"]
    weights = np.log((1.0 + len(x)) / (1.0 + (x > 0).sum(axis=0))).astype(np.float32) + np.float32(0.1)
    axes = _leading_axes(weighed(x, weights), DIMENSIONS)
    taught_labels = np.array([r["_label"] for r in rows], dtype=float)
    return Voters(weights, axes, _unit(weighed(x, weights) @ axes), taught_labels)


def add_score(df: DataFrame, voters: Voters, text_col: str = "text", name: str = "score") -> DataFrame:
    """Adds the share of label 1 among the nearest labelled documents, 0 to 1.

    Reads the text alone. Texts without words (null, empty, blank) score 0, as do
    those with no labelled text on their side of the space. The model, of a size set by
    the constants above, is broadcast; rows are scored where they lie.
    """
    held = df.sparkSession.sparkContext.broadcast(voters)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(held.value.scores(texts))

    return df.withColumn(name, score(F.col(f"`{text_col}`")))
