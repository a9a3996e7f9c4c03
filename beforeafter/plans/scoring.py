"""From snapshots to readiness scores."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from beforeafter.operators.axes import Axes, anchored, fit_axes, project
from beforeafter.operators.features import common_indicators
from beforeafter.operators.one_class import Boundary, add_label, fit_boundary
from beforeafter.operators.scaling import Scaling, reference_stats, scaled_rows
from beforeafter.operators.score import LEVELS, WEIGHTS, add_readiness, completeness, score_rows
from beforeafter.operators.sparse import add_label_sparse, fit_axes_sparse, fit_boundary_sparse, offset_of, project_sparse, sparse_rows
from beforeafter.schema import EVENT_KEYS
from beforeafter.staging import stage, stage_side


@dataclass(frozen=True)
class Prepared:
    """Both sides as scaled rows, not computed yet, and what was learnt on the reference side."""

    indicators: DataFrame
    scaling: Scaling
    reference_rows: DataFrame
    candidate_rows: DataFrame


def prepare(reference: DataFrame, candidates: DataFrame) -> Prepared:
    """Long reference (``entity, event_at``) and candidate (``entity``) values → scaled rows."""
    indicators = stage_side(common_indicators(reference, candidates), "common")
    scaling = Scaling.of(reference_stats(reference, indicators))
    if not scaling.width:
        raise ValueError("reference and candidates share no indicator that has reference values")
    return Prepared(
        indicators,
        scaling,
        scaled_rows(reference, scaling, EVENT_KEYS),
        scaled_rows(candidates, scaling, ["entity"]),
    )


@dataclass(frozen=True)
class Scored:
    scores: DataFrame
    details: DataFrame
    axes: Axes
    boundary: Boundary


def score_candidates(
    reference: DataFrame,
    candidates: DataFrame,
    anchors: tuple[str, str] | None = None,
    weights: Sequence[float] = WEIGHTS,
    levels: Sequence[float] = LEVELS,
    nu: float = 0.05,
    sparse: bool = False,
    **boundary_options,
) -> Scored:
    """Fit on reference snapshots, score candidate snapshots, both of which are written
    once here.

    ``anchors`` is the (high, low) pair of candidate ids that pins the first axis.
    ``sparse`` keeps rows as their known values (``operators.sparse``): for many
    indicators of which a row has few.
    """
    reference, candidates = stage(reference, "reference"), stage(candidates, "candidates")
    ready = prepare(reference, candidates)
    if sparse:
        offset = offset_of(ready.scaling)
        ref_rows = stage(sparse_rows(reference, ready.scaling, EVENT_KEYS), "reference-rows")
        cand_rows = stage(sparse_rows(candidates, ready.scaling, ["entity"]), "candidate-rows")
        axes = fit_axes_sparse(ref_rows, offset, len(weights))
        boundary = fit_boundary_sparse(ref_rows, offset, nu, **boundary_options)
        ref_axes, cand_axes = project_sparse(ref_rows, axes, offset), project_sparse(cand_rows, axes, offset)
    else:
        ref_rows = stage(ready.reference_rows, "reference-rows")
        cand_rows = stage(ready.candidate_rows, "candidate-rows")
        axes = fit_axes(ref_rows, len(weights))
        boundary = fit_boundary(ref_rows, nu, **boundary_options)
        ref_axes, cand_axes = project(ref_rows, axes), project(cand_rows, axes)
    if anchors:
        flat = cand_axes.select("entity", "axis_1")
        ref_axes, cand_axes = (anchored(f, flat, *anchors) for f in (ref_axes, cand_axes))
    ready_rows = add_readiness(cand_axes, ref_axes, weights, levels)
    details = add_label_sparse(ready_rows, boundary, offset) if sparse else add_label(ready_rows, boundary)
    scores = score_rows(details, completeness(candidates, ready.indicators))
    return Scored(scores, details.drop("z", "slots", "deltas"), axes, boundary)
