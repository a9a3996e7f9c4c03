"""Scalar expressions. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """A column whose name may hold dots, as pivoted indicator codes do."""
    return F.col("`" + name.replace("`", "``") + "`")


def clean_number(col: Column) -> Column:
    """Number or NULL: text that is no number, NaN and infinities become NULL."""
    number = col.try_cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def time_index(ts: Column, unit: str) -> Column:
    """Integer time of a timestamp: year, month number or days since 1970."""
    if unit == "year":
        return F.year(ts)
    if unit == "month":
        return (F.year(ts) * 12 + F.month(ts)).cast("int")
    if unit == "day":
        return F.unix_date(F.to_date(ts))
    raise ValueError(f"unit must be year, month or day, not {unit!r}")


def percent_change(value: Column, baseline: Column) -> Column:
    """Change from the baseline in percent of its size; NULL without a baseline."""
    return F.when(baseline != 0.0, (value - baseline) / F.abs(baseline) * 100.0)


def signed_log(value: Column) -> Column:
    """Logarithm of the magnitude plus one, with the sign kept."""
    return F.signum(value) * F.log1p(F.abs(value))


def interpolate(x: Column, knots: Sequence[tuple[Column, Column]]) -> Column:
    """Piecewise-linear map through ``knots`` (sorted by position), ends held flat.

    Where knots share a position the last of them gives the value there.
    """
    first_x, first_y = knots[0]
    last_x, last_y = knots[-1]
    out = F.when(x >= last_x, last_y)
    for (x0, y0), (x1, y1) in reversed(list(zip(knots, knots[1:]))):
        out = out.when(x >= x0, y0 + (y1 - y0) * (x - x0) / F.nullif(x1 - x0, F.lit(0.0)))
    return out.when(x < first_x, first_y)


def status_label(label: Column, lead: Column) -> Column:
    """Status of a candidate from its one-class label and first-axis lead."""
    # The three status texts.
    return (
        F.when((label == -1) & (lead > 0), F.lit("ELITE CANDIDATE"))
        .when(label == 1, F.lit("STANDARD VIABLE"))
        .otherwise(F.lit("HIGH RISK / DEVELOPING"))
    )
