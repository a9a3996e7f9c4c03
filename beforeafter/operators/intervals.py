"""Points within intervals, joined through time bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beforeafter.staging import broadcast_if_small, stage


def micros(moment: Column) -> Column:
    """What the clock shows at a timestamp as whole microseconds since 1970; the session's
    time zone plays no part for timestamps without one."""
    seconds = F.extract(F.lit("SECOND"), moment)
    minutes = (F.unix_date(F.to_date(moment)).cast("long") * 24 + F.hour(moment)) * 60 + F.minute(moment)
    return minutes * 60_000_000 + (seconds * 1_000_000).cast("long")


def _level(length: Column) -> Column:
    """Bin widths are powers of two: the least at which an interval meets two bins at most."""
    return F.when(length <= 1, F.lit(0)).otherwise(F.length(F.bin(length - 1))).cast("int")


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    on: Sequence[str],
    at: str,
    first: str,
    last: str,
    stage_points: bool = False,
) -> DataFrame:
    """Every point with every interval of the same key that it lies in, ends included.

    ``at``, ``first`` and ``last`` are whole numbers (``micros`` of timestamps); the
    other columns of both sides are kept and must have different names. Each interval
    is filed under the one or two bins that it meets at the width next to its own
    length, each point under its bin at every width in use, and both are joined on
    (key, width, bin) with the exact ends behind it: a point and an interval share one
    bin at most, so a hit comes once. Work grows with points times the widths in use
    (one for bands of a fixed length, never more than 64) and with what shares a bin,
    not with points times intervals, and a hot key is spread over its bins. The
    interval side is broadcast only while it measures small; a bin that is hot beyond
    that is split by adaptive execution. Null keys, times or ends and intervals that
    end before they begin meet nothing; repeated rows are rows of their own.

    ``intervals`` is written once and read twice. ``stage_points`` writes the points
    too, for sides that are dear to work out.
    """
    begin, end = F.col(f"`{first}`").cast("long"), F.col(f"`{last}`").cast("long")
    sound = intervals.filter((begin <= end) & F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in on)))
    filed = sound.withColumn("_width", _level(end - begin + 1))
    bins = F.sequence(F.expr(f"shiftright(CAST(`{first}` AS BIGINT), _width)"), F.expr(f"shiftright(CAST(`{last}` AS BIGINT), _width)"))
    filed = stage(filed.withColumn("_bin", F.explode(bins)), "intervals")
    # At most 64 numbers: the widths are powers of two.
    widths = sorted(r["_width"] for r in filed.select("_width").distinct().collect())
    points = stage(points, "points") if stage_points else points
    time = F.col(f"`{at}`").cast("long")
    if len(widths) == 1:
        dealt = points.withColumn("_width", F.lit(widths[0]))
    else:
        dealt = points.withColumn("_width", F.explode(F.array(*[F.lit(w) for w in widths]).cast("array<int>")))
    dealt = dealt.withColumn("_bin", F.expr(f"shiftright(CAST(`{at}` AS BIGINT), _width)"))
    keys = [*on, "_width", "_bin"]
    return dealt.join(broadcast_if_small(filed), keys).filter((time >= begin) & (time <= end)).drop("_width", "_bin")


def band_join(
    points: DataFrame, moments: DataFrame, on: Sequence[str], at: str, moment: str, before: int, after: int
) -> DataFrame:
    """Points from ``before`` ahead of a moment to ``after`` behind it, in the unit of both,
    with ``distance`` from the moment; see ``interval_join``."""
    when = F.col(f"`{moment}`").cast("long")
    banded = moments.withColumn("_first", when - before).withColumn("_last", when + after)
    met = interval_join(points, banded, on, at, "_first", "_last").drop("_first", "_last")
    return met.withColumn("distance", F.col(f"`{at}`").cast("long") - when)
