"""Quality rules as weak supervision: votes, estimated accuracies, a posterior."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beforeafter.llm.text import let, unused, words
from beforeafter.staging import stage

#: Words of a window whose repetition counts.
WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_shouts", "n_distinct")


@dataclass(frozen=True)
class Rule:
    """Votes bad (-1) where ``bad`` holds, good (+1) where ``good`` does, else abstains (0)."""

    name: str
    bad: str
    good: str


#: Ratios are per word; a row without words gets no ratio and so abstains there.
RULES = (
    Rule("length", "n_words < 20", "n_words BETWEEN 50 AND 100000"),
    Rule("word_length", "word_chars NOT BETWEEN 3 * n_words AND 10 * n_words", "word_chars BETWEEN 3.5 * n_words AND 7 * n_words"),
    Rule("symbols", "n_symbols > 0.1 * n_words", "n_symbols <= 0.02 * n_words"),
    Rule("lines", "n_dup_lines > 0.1 * n_words", "n_dup_lines <= 0.02 * n_words"),
    Rule("repeats", "n_repeat_words > 0.3 * n_words", "n_repeat_words <= 0.1 * n_words"),
    Rule("capitals", "n_capitals > 0.3 * word_chars", "n_capitals <= 0.1 * word_chars"),
    Rule("shouts", "n_shouts > 0.3 * n_words", "n_shouts <= 0.05 * n_words"),
    Rule("variety", "n_distinct < 0.2 * n_words AND n_words BETWEEN 20 AND 5000", "n_distinct >= 0.4 * n_words"),
)


def _covered(starts: Column) -> Column:
    """Words covered by windows at the given ascending starts."""
    gaps = F.transform(
        starts,
        lambda p, i: F.when(i == 0, F.lit(WINDOW)).otherwise(F.least(F.lit(WINDOW), p - F.get(starts, i - 1))),
    )
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)


def _again(hashes: Column) -> Column:
    """Ascending places of the values found twice or more in an array."""
    tagged = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def found(pairs: Column) -> Column:
        same = F.transform(
            pairs,
            lambda p, k: F.when(
                (p["h"].eqNullSafe(F.get(pairs, k - 1)["h"])) | (p["h"].eqNullSafe(F.get(pairs, k + 1)["h"])), p["i"]
            ),
        )
        return F.array_sort(F.array_compact(same))

    return let(tagged, found)


def repeat_words(word_list: Column) -> Column:
    """Words in windows of ``WINDOW`` words found twice or more, first ones included.

    Windows are compared by 64-bit hashes of their words' hashes. Texts of which all
    windows differ, the common case, end after one set look-up per window.
    """

    def of_hashes(h: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(h, i, WINDOW)))
        return let(
            windows,
            lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(let(_again(w), _covered)),
        )

    hashed = F.transform(word_list, lambda w: F.xxhash64(w))
    return F.when(F.size(word_list) > WINDOW, let(hashed, of_hashes)).otherwise(F.lit(0).cast("long"))


def _line_copies(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def measures(text: Column) -> Column:
    """The ``MEASURES`` of a text, as one struct of longs; null counts as empty."""
    text = F.coalesce(text, F.lit(""))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            _line_copies(text).alias("n_dup_lines"),
            repeat_words(w).alias("n_repeat_words"),
            F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
            (F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit("")))).cast("long").alias("n_shouts"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
        )

    return let(words(text), of_words)


def votes(rules: tuple[Rule, ...] = RULES) -> Column:
    """One tiny integer per rule; rows without words abstain throughout."""
    each = [F.when(F.col("n_words") == 0, 0).when(F.expr(r.bad), -1).when(F.expr(r.good), 1).otherwise(0) for r in rules]
    return F.array(*[v.cast("tinyint") for v in each])


@dataclass(frozen=True)
class VoteModel:
    """``priors[c]`` and ``chances[c][j]``: share of class c and, in it, the chances that
    rule j votes -1, 0 or 1. Class 0 is good; class j + 1 holds faults that rule j is
    made for. ``accuracy[j]``: how often a vote of rule j is right, by the estimate."""

    priors: tuple[float, ...]
    chances: tuple[tuple[tuple[float, float, float], ...], ...]
    accuracy: tuple[float, ...]

    def posterior(self, votes: Column) -> Column:
        """Chance that a row with these votes is good."""
        parts = []
        for prior, chance in zip(self.priors, self.chances):
            total = F.lit(math.log(prior))
            for j, (bad, none, good) in enumerate(chance):
                v = F.get(votes, F.lit(j))
                total = total + F.when(v < 0, math.log(bad)).when(v > 0, math.log(good)).otherwise(math.log(none))
            parts.append(F.exp(total))
        return parts[0] / sum(parts[1:], parts[0])


#: Beliefs (votes -1, 0, 1), each worth ``BELIEF_ROWS`` rows, that the estimates
#: are drawn to: a rule catches nearly all faults it is made for, and raises few false alarms.
OWN_FAULT = (0.95, 0.04, 0.01)
ON_GOOD = (0.001, 0.05, 0.949)
BELIEF_ROWS = 20.0
#: Bad votes of other rules at which what is read off them weighs as much as the belief.
EVEN_VOTES = 50.0
#: By definition of a class: its own rule sees its faults at least this often.
LEAST_HIT = 0.5


def false_alarms(bad: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Estimates of each rule's chance of a false alarm.

    A false alarm comes whatever other rules see, so it comes among the bad votes of
    every other rule: the least share that a rule has there, with ``ON_GOOD`` added. A
    share of few votes says little: in logarithms it is drawn to the rule's share of all
    rows, which is never less than its alarms, and the least one to the belief
    ``ON_GOOD``, each by the number of votes it rests on. So estimates move smoothly
    with the counts.
    """
    both = bad.T @ (bad * count[:, None])
    given = np.diag(both)
    believed = math.log(ON_GOOD[0])
    overall = np.log(np.maximum((count @ bad) / count.sum(), ON_GOOD[0]))
    shares = np.log((both + BELIEF_ROWS * ON_GOOD[0]) / (given + BELIEF_ROWS)[None, :])
    weight = (given / (given + EVEN_VOTES))[None, :]
    drawn = np.minimum(weight * shares + (1 - weight) * overall[:, None], overall[:, None])
    np.fill_diagonal(drawn, np.inf)
    least = np.minimum(drawn.min(axis=1), overall) if len(given) > 1 else overall
    others = given.sum() - given
    weight = others / (others + EVEN_VOTES)
    return np.exp((1 - weight) * believed + weight * least)


def estimate(patterns: list[tuple[tuple[int, ...], int]], n_rules: int, tol: float = 1e-7, max_rounds: int = 100_000) -> VoteModel:
    """Expectation-maximisation over counted vote patterns.

    A row is good or has one kind of fault, and given that its rules vote
    independently. Faults of one kind pass most other rules, so with a single bad
    class the votes of one kind's rules would outvote all others; with a class per
    rule each is judged by its own votes. All chances are estimated, hits on a rule's
    own faults too, with beliefs (``OWN_FAULT``, ``ON_GOOD``) as heavy as
    ``BELIEF_ROWS`` rows, whatever the size, and one vote added to each other estimate.
    A lone bad vote could be a fault or a false alarm, and the likelihood is flat
    between the two, so the chances of false alarms are read off votes cast together
    (``false_alarms``) and the rounds estimate the rest. A class stays what it is named
    for by ``LEAST_HIT``. Raises if the rounds run out.
    """
    n_classes = n_rules + 1
    if not patterns:
        none = ((1 / 3, 1 / 3, 1 / 3),) * n_rules
        return VoteModel((1 / n_classes,) * n_classes, (none,) * n_classes, (0.5,) * n_rules)
    count = np.array([c for _, c in patterns], dtype=float)
    votes = np.array([p for p, _ in patterns])
    onehot = (votes[:, :, None] == np.array([-1, 0, 1])).astype(float)
    bad = onehot[:, :, 0]
    alarms = false_alarms(bad, count)
    own = np.arange(n_rules)
    added = np.ones((n_classes, n_rules, 3))
    on_good = np.array(ON_GOOD[1:]) / sum(ON_GOOD[1:])
    added[0, :, 1:] = BELIEF_ROWS * on_good
    added[own + 1, own] = BELIEF_ROWS * np.array(OWN_FAULT)

    # First chances: on good rows those without bad votes and the alarms, in a class
    # those of the rows its rule votes bad on.
    held = np.column_stack([(bad == 0).all(axis=1), bad]) * count[:, None]
    chances = np.einsum("pc,pjv->cjv", held, onehot) + added
    chances[0, :, 1:] *= ((1 - alarms) / chances[0, :, 1:].sum(axis=1))[:, None]
    chances[0, :, 0] = alarms
    chances[own + 1, own] = OWN_FAULT
    chances /= chances.sum(axis=2, keepdims=True)
    fault = np.maximum((count @ bad) / count.sum() - alarms, 0.0) * count.sum() + 1.0
    priors = np.concatenate([[max(count.sum() - fault.sum(), 0.0) + 1.0], fault])
    priors /= priors.sum()
    share = np.zeros((len(count), n_classes))
    moved = np.inf
    for _ in range(max_rounds):
        log = np.log(priors) + np.einsum("cjv,pjv->pc", np.log(chances), onehot)
        new = np.exp(log - log.max(axis=1, keepdims=True))
        new /= new.sum(axis=1, keepdims=True)
        moved = float(np.abs(new - share).max())
        share = new
        if moved <= tol:
            break
        held = share * count[:, None]
        sums = np.einsum("pc,pjv->cjv", held, onehot) + added
        chances = sums / sums.sum(axis=2, keepdims=True)
        chances[0, :, 1:] *= ((1 - alarms) / chances[0, :, 1:].sum(axis=1))[:, None]
        chances[0, :, 0] = alarms
        hit = chances[own + 1, own]
        low = hit[:, 0] < LEAST_HIT
        rest = hit[:, 1:] * ((1 - LEAST_HIT) / hit[:, 1:].sum(axis=1))[:, None]
        chances[own + 1, own] = np.where(low[:, None], np.column_stack([np.full(n_rules, LEAST_HIT), rest]), hit)
        priors = (held.sum(axis=0) + 1.0) / (count.sum() + n_classes)
    else:
        raise ArithmeticError(f"votes not settled after {max_rounds} rounds: still moving by {moved:.3g}")
    good = share[:, 0] * count
    right = good @ onehot[:, :, 2] + (count - good) @ onehot[:, :, 0]
    cast = count @ (onehot[:, :, 0] + onehot[:, :, 2])
    accuracy = np.where(cast > 0, right / np.maximum(cast, 1.0), 0.5)
    return VoteModel(
        tuple(map(float, priors)),
        tuple(tuple(tuple(map(float, v)) for v in c) for c in chances),
        tuple(map(float, accuracy)),
    )


def judge_quality(
    df: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, threshold: float = 0.5, carry: list[str] | None = None
) -> DataFrame:
    """Adds the measures, ``base_failed``, ``votes``, ``posterior`` and ``kept``.

    Votes of all rows are counted by pattern in Spark (at most 3 to the number of
    rules, whatever the rows), the accuracies of the rules estimated from the counts,
    and every row gets the posterior chance of being good. ``base_failed``: fewer
    than 20 words, or more than 30 % of them repeated; such rows are not kept. Null
    and empty texts have no words. ``carry`` names the columns kept (default all);
    columns of the new names are replaced. Empty tables stay empty.
    """
    new = {*MEASURES, "base_failed", "votes", "posterior", "kept"}
    carry = [c for c in (df.columns if carry is None else carry) if c.lower() not in new]
    name = unused("_m", carry)
    measured = df.select(*[F.col(f"`{c}`") for c in carry], measures(F.col(f"`{text_col}`")).alias(name))
    measured = measured.select(*[F.col(f"`{c}`") for c in carry], *[F.col(name)[m].alias(m) for m in MEASURES])
    # Written once, as the measures are read for the counts and for the verdicts.
    rows = stage(measured.withColumn("votes", votes(rules)), "rule-votes")
    patterns = [(tuple(r["votes"]), r["count"]) for r in rows.groupBy("votes").count().collect()]
    model = estimate(sorted(patterns), len(rules))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    judged = rows.withColumn("base_failed", failed).withColumn("posterior", model.posterior(F.col("votes")))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
