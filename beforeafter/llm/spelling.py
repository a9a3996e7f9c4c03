"""Spelling variants: words one edit apart, found by PartEnum signatures of their letters."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import combinations

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beforeafter.staging import broadcast_if_small, stage

#: Second-level parts for words of equal length (letters differ in two places) and of
#: lengths one apart (in one place).
REPLACED_PARTS = 4
SHIFTED_PARTS = 2
#: Words whose signatures one task makes.
TASK_WORDS = 20_000


def runs(text: Column, least: int) -> Column:
    """Maximal runs of A-Z, a-z and U+00C0-U+00FF of ``least`` code points or more, A-Z
    lower-cased; a null text has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lowered, F.lit(f"([a-zÀ-ÿ]{{{least},}})"), F.lit(0))


def word_counts(words: DataFrame, least_length: int, least_count: int) -> DataFrame:
    """``word`` and ``n``: how often each word of the column ``word`` occurs, without
    those shorter or rarer. Counts are added up before the shuffle; nulls are left out."""
    long_enough = words.filter(F.length("word") >= least_length)
    return long_enough.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def enumerated(distance: int, first: int, second: int) -> list[tuple[int, ...]]:
    """Which parts each signature keeps, for vectors at most ``distance`` apart.

    The dimensions are cut into ``first`` parts, one of which differs in no more than
    an even share of the distance; that one is cut into ``second`` parts each, and the
    share of them that may differ is left out in every possible way. Two vectors
    within the distance agree on the parts of at least one signature.
    """
    share = -(-(distance + 1) // first) - 1
    if share >= second:
        raise ValueError(f"{second} second-level parts leave none beside {share} that differ")
    return [
        tuple(i * second + j for j in kept) for i in range(first) for kept in combinations(range(second), second - share)
    ]


def _part_sums(word: str, parts: int, dims: dict[tuple[str, int], int]) -> list[int]:
    """One 64-bit number per part: the sum of the hashes of the word's dimensions in it.

    A dimension of the binary vector is a letter and how many-th of its kind it is.
    """
    seen: dict[str, int] = {}
    sums = [0] * parts
    for letter in word:
        at = letter, seen.get(letter, 0)
        seen[letter] = at[1] + 1
        h = dims.get(at)
        if h is None:
            h = dims[at] = xxhash.xxh64_intdigest(f"{letter}{at[1]}".encode())
        sums[(h >> 32) % parts] += h
    return [s & 0xFFFFFFFFFFFFFFFF for s in sums]


def signatures(word: str, dims: dict[tuple[str, int], int]) -> Iterator[int]:
    """Signed 64-bit keys; words one edit apart share at least one.

    One edit changes the letters in two places (replaced) or one (inserted, deleted),
    so words are compared by kind and the length of the shorter one, with PartEnum for
    that distance. It also leaves the first or the last half alone, which is part of
    the key: words of the same letters in another order meet less often.
    """
    n = len(word)
    kinds = ((0, n, n // 2, 2, REPLACED_PARTS), (1, n, (n + 1) // 2, 1, SHIFTED_PARTS), (1, n - 1, n // 2, 1, SHIFTED_PARTS))
    for kind, length, half, distance, parts in kinds:
        if length < 0:  # nothing is shorter than the empty word
            continue
        sums = _part_sums(word, parts, dims)
        for kept in enumerated(distance, 1, parts):
            head = bytes(kept) + struct.pack(f"<{len(kept) + 1}Q", 2 * length + kind, *(sums[j] for j in kept))
            for side, anchor in ((b"<", word[:half]), (b">", word[n - half :])):
                yield xxhash.xxh64_intdigest(head + side + anchor.encode()) - (1 << 63)


def near_pairs(words: DataFrame) -> DataFrame:
    """``a``, ``a_n``, ``b``, ``b_n`` with a < b: all pairs exactly one edit apart, once.

    ``words`` has distinct words ``word`` with ``n``. Signatures are joined with each
    other on equal keys, never words with words; every pair that meets is verified.
    """

    @F.pandas_udf("array<long>")
    def keys(found: pd.Series) -> pd.Series:
        dims: dict[tuple[str, int], int] = {}
        return pd.Series([list(signatures(w, dims)) for w in found])

    # A vocabulary is small beside its signatures: deal it by rows, not by bytes.
    tasks = words.count() // TASK_WORDS + 1
    signed = words.repartition(tasks, "word").select("word", "n", F.explode(keys("word")).alias("key"))
    a = signed.select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
    b = signed.select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))
    # A merge join: the planner takes an explode for no larger than its input, and a
    # frequent key is split by adaptive execution.
    met = a.join(b.hint("merge"), "key").filter((F.col("a") < F.col("b")) & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "a_n", "b", "b_n").distinct()


def forms(words: DataFrame, ratio: int = 5) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` for each word.

    ``words`` has ``word`` and ``n``; rows without a word are left out and counts of
    repeated words added. Two words are near if one inserted, deleted or replaced code
    point makes one the other. The form is the near word of greatest n (ties: least in
    code-point order) if that is ``ratio`` times the word's n or more, else null;
    the root follows forms to the last one, the word itself without a form; ``n_near``
    counts near words. Other columns are ignored; an empty table stays empty.
    """
    total = words.filter(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    total = stage(total, "spelling-words")
    pairs = near_pairs(total)
    # A word has no more near words than places and letters, so its rows stay few.
    sides = pairs.selectExpr("inline(array(named_struct('word', a, 'near', b, 'near_n', b_n), named_struct('word', b, 'near', a, 'near_n', a_n)))")
    best = F.min(F.struct((-F.col("near_n")).alias("key"), F.col("near").alias("near")))
    near = sides.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    chosen = F.col("best")["key"] <= -F.lit(ratio) * F.col("n")
    formed = total.join(near, "word", "left").select(
        "word",
        F.when(chosen, F.col("best")["near"]).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(chosen, -F.col("best")["key"]).alias("form_n"),
    )
    formed = stage(formed, "spelling-forms")
    roots = _roots(formed.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    return formed.join(broadcast_if_small(roots), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(links: DataFrame) -> DataFrame:
    """Follows ``root`` until it has no further link, twice as far each round.

    Each step multiplies the count by the ratio, so chains are short and have no rings.
    """
    links = stage(links, "spelling-roots")
    while True:
        on = links.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        further = links.join(broadcast_if_small(on), F.col("root") == F.col("_at"), "left")
        followed = stage(further.select("word", F.coalesce("_next", "root").alias("root"), F.col("_at").isNotNull().alias("moved")), "spelling-roots")
        if followed.filter("moved").isEmpty():
            return followed.select("word", "root")
        links = followed.select("word", "root")
