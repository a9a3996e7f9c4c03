"""Near duplicates by SimHash: fingerprints, ball hashing of variants, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beforeafter.llm.components import connected
from beforeafter.staging import broadcast_if_small, stage

BITS = 64
SEED = 42
#: Shingles whose bits are unpacked at a time.
CHUNK = 65_536
#: Fingerprints whose variants one task makes.
TASK_FINGERPRINTS = 10_000


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Signed 64-bit SimHash of a whole text.

    A-Z are lower-cased, words split at ASCII white space, and every run of
    ``shingle`` words, repeats included, joined by spaces and hashed (XXH64, seed 42);
    fewer words make one shingle. A bit is 1 if more than half the hashes set it.
    Null, empty and blank texts have fingerprint 0.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = np.array([digest(joined, SEED)], dtype=np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = [0, *(ends[: len(words) - shingle] + 1).tolist()]
        spans = zip(starts, ends[shingle - 1 :].tolist())
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(starts))
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at : at + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def add_fingerprint(df: DataFrame, text_col: str, shingle: int, name: str) -> DataFrame:
    """Adds the fingerprint as a long, computed text by text inside tasks."""

    @F.pandas_udf("long")
    def fingerprints(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return df.withColumn(name, fingerprints(F.col(f"`{text_col}`")))


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), BITS // 4, "0"))


def _flips(bits: range | list[int], n: int) -> list[int]:
    return [sum(1 << b for b in chosen) for chosen in combinations(bits, n)]


def _variants(fp: Column, masks: list[tuple[int, int, int]]) -> Column:
    """``(fp ^ flip) & keep | tag`` for each mask (flip, keep, tag)."""
    each = []
    for keep, tag in dict.fromkeys(m[1:] for m in masks):
        flips = F.array(*[F.lit(_signed(m[0])) for m in masks if m[1:] == (keep, tag)])
        each.append(
            F.transform(flips, lambda x: fp.bitwiseXOR(x).bitwiseAND(F.lit(_signed(keep))).bitwiseOR(F.lit(_signed(tag))))
        )
    return F.concat(*each)


def kept_bit_masks(distance: int) -> list[tuple[int, int, int]]:
    """Masks of all variants within half the distance, on the bits kept.

    Two fingerprints at most ``distance`` apart share a variant if either flips half
    of that. An odd distance has no half: its bits are cut into as many blocks as the
    distance counts (two at least), so one block differs in a bit or more, or all
    agree; with that block dropped the rest differ by an even number or less. The
    number of the dropped block stands in its place. Sharing such a variant is
    necessary, not sufficient.
    """
    whole = (1 << BITS) - 1
    if distance % 2 == 0:
        return [(f, whole, 0) for n in range(distance // 2 + 1) for f in _flips(range(BITS), n)]
    blocks = max(2, distance)
    cuts = [BITS * k // blocks for k in range(blocks + 1)]
    masks = []
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        kept = [x for x in range(BITS) if not a <= x < b]
        keep = sum(1 << x for x in kept)
        masks += [(f, keep, k << a) for n in range(distance // 2 + 1) for f in _flips(kept, n)]
    return masks


def ball_masks(distance: int) -> tuple[list[int], list[int]]:
    """Flips of whole fingerprints: near ones for all, far ones for odd parity only.

    Near: up to floor(distance / 2) bits. Two near variants that meet are within the
    distance. Far, for an odd distance 2k + 1 alone: k + 1 bits, all in one half. Two
    fingerprints exactly that far apart have unlike parity, k + 1 of the differing
    bits lie in one half, and the odd one reaches by flipping them what the even one
    reaches by flipping the others. A far and a near variant that meet are within the
    distance.
    """
    near = [f for n in range(distance // 2 + 1) for f in _flips(range(BITS), n)]
    if distance % 2 == 0:
        return near, []
    half = BITS // 2
    return near, [f for part in (range(half), range(half, BITS)) for f in _flips(list(part), distance // 2 + 1)]


def _meeting(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Fingerprints of rows, sorted by key, that share their key with a neighbour.

    Reads a partition as a stream, so that a key of any size takes no more memory."""
    last_key, last_fp = None, None
    for batch in batches:
        key, fp = batch["key"].to_numpy(), batch["fp"].to_numpy()
        if not len(key):
            continue
        same = key[1:] == key[:-1]
        hit = np.zeros(len(key), dtype=bool)
        hit[1:] |= same
        hit[:-1] |= same
        found = [fp[hit]]
        if last_key is not None and key[0] == last_key:
            found.append(np.array([last_fp, fp[0]]))
        last_key, last_fp = key[-1], fp[-1]
        yield pd.DataFrame({"fp": np.unique(np.concatenate(found))})


def linked(fps: DataFrame, distance: int) -> DataFrame:
    """Links ``a``, ``b`` that connect distinct fingerprints (column ``fp``) exactly as
    all pairs at most ``distance`` bits apart do, without listing those pairs.

    Meet in the middle, twice. First every fingerprint emits its variants within half
    the distance on the kept bits; fingerprints that share none with another are far
    from all and drop out. The others emit the balls of ``ball_masks``, and at each
    variant all link to the least fingerprint that is near it. Every such link is
    checked by its bit distance, and every close pair meets at some variant with a
    near one, so the work grows with the fingerprints, not with pairs in a group.
    """
    fp = F.col("fp")
    # A fingerprint is small beside its variants: deal them by rows, not by bytes.
    fps = fps.repartition(fps.count() // TASK_FINGERPRINTS + 1, "fp")
    rows = fps.select(fp, F.explode(_variants(fp, kept_bit_masks(distance))).alias("key"))
    met = rows.repartition("key").sortWithinPartitions("key").mapInPandas(_meeting, "fp long")
    close = stage(met.distinct(), "simhash-close")

    near, far = ball_masks(distance)
    whole = (1 << BITS) - 1
    near_rows = close.select(fp, F.explode(_variants(fp, [(f, whole, 0) for f in near])).alias("key"), F.lit(True).alias("near"))
    rows = near_rows
    if far:
        odd = close.filter(F.bit_count(fp) % 2 == 1)
        rows = rows.unionByName(
            odd.select(fp, F.explode(_variants(fp, [(f, whole, 0) for f in far])).alias("key"), F.lit(False).alias("near"))
        )
    hubs = near_rows.groupBy("key").agg(F.min("fp").alias("hub"))
    # A merge join: the planner takes an explode for no larger than its input.
    met = rows.join(hubs.hint("merge"), "key").filter((fp != F.col("hub")) & (F.bit_count(fp.bitwiseXOR(F.col("hub"))) <= distance))
    return met.select(fp.alias("a"), F.col("hub").alias("b")).distinct()


def classes(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    distance: int = 3,
    carry: list[str] | None = None,
) -> DataFrame:
    """One row per row of ``df``: the columns in ``carry`` (default: the id), then
    ``fingerprint`` (16 hexadecimal digits), ``component_id`` and ``kept``.

    Fingerprints at most ``distance`` bits apart are linked, equal ones too, texts
    without words like any other. ``component_id`` is the least id reachable (nulls
    count last: null only where no member has an id) and one row of each component is
    kept, the first with that id. Repeated rows are rows of their own; an empty table
    stays empty. Columns of the new names are replaced.
    """
    new = ("fingerprint", "component_id", "kept")
    carry = [c for c in (carry or [id_col]) if c.lower() not in new]
    return _classes(_fingerprinted(df, id_col, text_col, shingle, carry), distance).select(
        *[F.col("row")[c].alias(c) for c in carry], hexadecimal(F.col("fp")).alias("fingerprint"), "component_id", "kept"
    )


def one_of_each(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3
) -> DataFrame:
    """The rows of ``df``, one of each component of ``classes``, with its columns.

    The table is written once with row numbers; only those of the rows that go, or
    both sides if these are many, travel to drop them.
    """
    rows = _fingerprinted(df, id_col, text_col, shingle, df.columns)
    gone = stage(_classes(rows.drop("row"), distance).filter(~F.col("kept")).select("uid"), "simhash-gone")
    return rows.join(broadcast_if_small(gone), "uid", "left_anti").select(*[F.col("row")[c].alias(c) for c in df.columns])


def _fingerprinted(df: DataFrame, id_col: str, text_col: str, shingle: int, carry: list[str]) -> DataFrame:
    """``row`` (the carried columns), ``id``, ``fp`` and ``uid``, written once, so that
    the texts are hashed once and row numbers stay."""
    packed = df.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{text_col}`").alias("text"),
        F.monotonically_increasing_id().alias("uid"),
    )
    return stage(add_fingerprint(packed, "text", shingle, "fp").drop("text"), "simhash-rows")


def _classes(rows: DataFrame, distance: int) -> DataFrame:
    """Adds ``component_id`` and ``kept`` to fingerprinted rows."""
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("uid").alias("uid")))
    per_fp = stage(rows.groupBy("fp").agg(first.alias("first")), "simhash-fps")
    roots = connected(linked(per_fp.select("fp"), distance))
    rooted = per_fp.join(roots, F.col("fp") == F.col("node"), "left").select(
        F.col("fp").alias("of"), F.coalesce("root", "fp").alias("root"), "first"
    )
    heads = rooted.groupBy("root").agg(F.min("first").alias("head"))
    table = stage(rooted.join(heads, "root").select("of", "head"), "simhash-classes")
    # A third of all rows may share a fingerprint: an ordinary join, which adaptive
    # execution splits.
    return rows.join(table, F.col("fp") == F.col("of")).select(
        *rows.columns, F.col("head")["id"].alias("component_id"), (F.col("head")["uid"] == F.col("uid")).alias("kept")
    )
