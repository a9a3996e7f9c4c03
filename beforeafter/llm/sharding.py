"""Shards by a Feistel permutation of global row numbers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beforeafter.llm.ranks import numbered
from beforeafter.llm.text import unused

#: Rounds of the network, each of which changes both digits.
ROUNDS = 4
#: Steps of a cycle walk. Fewer than one place in sqrt(n) lies outside the rows, and
#: for small n there are fewer places outside than steps; a longer walk raises.
WALK = 64


def bases(n: int) -> tuple[int, int]:
    """Bases a and b of the two digits: a is the root of n rounded up, a * b >= n."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def permuted(row: str, n: int, seed: int, inverse: bool = False) -> Column:
    """Image of the number in column ``row`` under a keyed permutation of 0 .. n-1.

    A number is a pair of digits; a round adds to each digit a keyed hash of the
    other, which can be undone whatever the hash. Images at or above n are mapped
    again until they fall below it (cycle walking), so 0 .. n-1 maps onto itself.
    """
    a, b = bases(n)
    keys = [f"{seed * 1_000 + k}L" for k in range(ROUNDS)]
    left, right = f"pmod(xxhash64(%s, 'l', k), {a}L)", f"pmod(xxhash64(%s, 'r', k), {b}L)"
    if inverse:
        keys.reverse()
        new_r = f"pmod(s.r - {right % 's.l'}, {b}L)"
        step = f"named_struct('l', pmod(s.l - {left % new_r}, {a}L), 'r', {new_r})"
    else:
        new_l = f"pmod(s.l + {left % 's.r'}, {a}L)"
        step = f"named_struct('l', {new_l}, 'r', pmod(s.r + {right % new_l}, {b}L))"
    once = (
        f"aggregate(array({', '.join(keys)}), named_struct('l', %s div {b}L, 'r', %s % {b}L), "
        f"(s, k) -> {step}, s -> s.l * {b}L + s.r)"
    ).replace(f"%s % {b}L", f"mod(%s, {b}L)")
    walked = f"aggregate(sequence(1, {WALK}), {once % ((f'`{row}`',) * 2)}, (y, i) -> if(y < {n}L, y, {once % (('y',) * 2)}))"
    return F.expr(f"transform(array({walked}), y -> if(y < {n}L, y, raise_error('cycle walk too long')))[0]")


def shards(df: DataFrame, n_shards: int, order: list[Column], seed: int = 17) -> DataFrame:
    """Adds ``shard`` (int), ``slot`` (long) and ``row_no`` (long).

    Rows are numbered in the given order, the numbers shuffled by ``permuted``, and
    the image p goes to shard p mod n_shards, slot p div n_shards: shards differ by at
    most one row and slots have no gaps. Where a row went, and which row lies in a
    slot (``row_in_slot``), is arithmetic on n and the seed. The frame is evaluated
    more than once while it is dealt by range: stage what is costly before. Columns
    of the new names are replaced. Rows that tie in the whole order are
    interchangeable; nulls sort as the order says; an empty frame stays empty.
    """
    kept = df.drop(*[c for c in df.columns if c.lower() in ("shard", "slot", "row_no")])
    rows = numbered(kept, order, name="row_no")
    place = unused("_p", rows.columns)
    n = rows.count()
    return rows.withColumn(place, permuted("row_no", n, seed)).select(
        *[F.col(f"`{c}`") for c in kept.columns],
        F.expr(f"mod({place}, {n_shards}L)").cast("int").alias("shard"),
        F.expr(f"{place} div {n_shards}L").alias("slot"),
        "row_no",
    )


def row_in_slot(slots: DataFrame, n: int, n_shards: int, seed: int = 17) -> DataFrame:
    """Adds ``row_no`` to rows of ``shard`` and ``slot``: the inverse of ``shards``."""
    place = unused("_p", slots.columns)
    at = slots.withColumn(place, F.col("slot") * F.lit(n_shards).cast("long") + F.col("shard"))
    return at.withColumn("row_no", permuted(place, n, seed, inverse=True)).drop(place)
