"""Cross-entropy difference between a target and a background bigram model.

Both models know every word and bigram of the corpus; what they gather grows with it
and is never on the driver. Texts are read three times: to count words, to count pairs
of frequent words, and to deal bigrams to buckets. A bucket holds all occurrences of its
bigrams, so it counts them and adds up what they cost each text without asking elsewhere.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beforeafter.llm.text import unused, word_count
from beforeafter.staging import stage

#: Pseudo-counts that a context deals by the frequencies of single words.
OWN = 64.0
#: Occurrences of a bucket on average, and buckets at least.
BUCKET_WORDS = 2_000_000
LEAST_BUCKETS = 16
#: Texts and words that are cut up at a time, occurrences whose losses are, and hashes of
#: words that are remembered.
SLICE_TEXTS = 16_384
SLICE_WORDS = 750_000
STEP_WORDS = 250_000
REMEMBERED = 100_000
#: The context of a text's first word: the hash of the empty word.
START = np.uint64(xxhash.xxh64_intdigest(b""))

_NEW = ("n_tokens", "target_loss", "background_loss", "score")
_COUNTS = ("b", "t", "cb", "ct")
_DEALT = (
    "bucket int, kind int, slice long, words binary, at binary, contexts binary, before binary, texts binary, used binary, "
    "target binary, keys binary, counts binary"
)
_SUMMED = "slice long, keys binary, used binary, sums binary"


@dataclass(frozen=True)
class Slice:
    """Some texts cut into words: hashes of words and of their contexts, the number of the
    text and whether the word is its last, and each text's key and whether it is a target."""

    words: np.ndarray
    contexts: np.ndarray
    texts: np.ndarray
    last: np.ndarray
    keys: np.ndarray
    target: np.ndarray


class Cutter:
    """Cuts batches of texts (``key``, ``text``, ``target``) into slices of bounded size;
    a text longer than that is a slice of its own."""

    def __init__(self) -> None:
        self.hashes: dict[bytes, int] = {}

    def hashed(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        known = self.hashes
        if len(known) > REMEMBERED:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def slices(self, batches: Iterator[pd.DataFrame]) -> Iterator[Slice]:
        for batch in batches:
            held: list[np.ndarray] = []
            rows: list[int] = []
            size = 0
            for i, text in enumerate(batch["text"]):
                words = self.hashed(text)
                if len(words):
                    held.append(words)
                    rows.append(i)
                    size += len(words)
                if held and (size >= SLICE_WORDS or len(held) >= SLICE_TEXTS or i == len(batch) - 1):
                    yield self._slice(held, batch.iloc[rows])
                    held, rows, size = [], [], 0
            if held:
                yield self._slice(held, batch.iloc[rows])

    @staticmethod
    def _slice(held: list[np.ndarray], rows: pd.DataFrame) -> Slice:
        lengths = np.array([len(w) for w in held])
        words = np.concatenate(held)
        ends = np.cumsum(lengths)
        contexts = np.concatenate([[START], words[:-1]]).astype(np.uint64)
        contexts[ends[:-1]] = START
        last = np.zeros(len(words), dtype=bool)
        last[ends - 1] = True
        return Slice(
            words, contexts, np.repeat(np.arange(len(held), dtype=np.uint16), lengths), last,
            rows["key"].to_numpy(dtype=np.int64), rows["target"].to_numpy(dtype=bool),
        )


def _word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each word: how often it occurs in all texts and in targets (``b``, ``t``), and
    how often as a context (``cb``, ``ct``)."""
    for s in Cutter().slices(batches):
        words, at = np.unique(s.words, return_inverse=True)
        target = s.target[s.texts].astype(float)
        n, going = len(words), ~s.last
        counted = [
            np.bincount(at, minlength=n), np.bincount(at, target, n),
            np.bincount(at[going], minlength=n), np.bincount(at[going], target[going], n),
        ]
        frame = pd.DataFrame({"word": words.view(np.int64), **{c: x.astype(np.int64) for c, x in zip(_COUNTS, counted)}})
        start = pd.DataFrame([[START.view(np.int64), 0, 0, len(s.keys), int(s.target.sum())]], columns=["word", *_COUNTS])
        yield pd.concat([frame, start])


@dataclass(frozen=True)
class Model:
    """What all buckets know: sizes of both models, the frequent words and bigrams. There
    are at most four of either to a bucket, so the table grows with the buckets alone."""

    buckets: int
    n_words: int
    target_size: float
    scale: float
    hot_words: np.ndarray
    hot_counts: np.ndarray
    hot_pairs: np.ndarray
    pair_counts: np.ndarray

    def losses(self, counts: np.ndarray, pairs: np.ndarray, going: np.ndarray) -> np.ndarray:
        """Losses under both models (two columns, background first) of occurrences, by the
        counts of their words and bigrams. A word's loss falls apart into one of its
        bigram and one of its context; the latter is charged to the context's own place."""
        out = np.empty((len(counts), 2))
        for k, scale in enumerate((self.scale, 1.0)):
            single = (scale * counts[:, k] + 1.0) / (self.target_size + self.n_words + 1.0)
            out[:, k] = -np.log(scale * pairs[:, k] + OWN * single)
            out[:, k] += np.where(going, np.log(scale * counts[:, 2 + k] + OWN), 0.0)
        return out

    def known(self, words: np.ndarray) -> np.ndarray:
        return _found(self.hot_words, words)

    def bucket(self, words: np.ndarray, contexts: np.ndarray, hot: np.ndarray) -> np.ndarray:
        """A word's bucket; bigrams of a frequent word are spread by their context."""
        mixed = np.where(hot, words ^ (contexts * np.uint64(0x9E3779B97F4A7C15)), words)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return ((mixed >> np.uint64(33)) % np.uint64(self.buckets)).astype(np.int32)


def _found(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Places of the values in an ascending table; -1 for those not in it."""
    if not len(table):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return np.where(table[at] == values, at, -1)


def _pairs(contexts: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
    """Number of a pair of places below n."""
    return contexts.astype(np.int64) * n + words


def _hot_pair_counts(model: Model):
    """Occurrences of bigrams of two frequent words (a text's start counts as one)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = len(model.hot_words)
        for s in Cutter().slices(batches):
            w, c = model.known(s.words), model.known(s.contexts)
            both = (w >= 0) & (c >= 0)
            pairs, at = np.unique(_pairs(c[both], w[both], n), return_inverse=True)
            target = s.target[s.texts[both]].astype(float)
            yield pd.DataFrame({"pair": pairs, "b": np.bincount(at, minlength=len(pairs)), "t": np.bincount(at, target, len(pairs)).astype(np.int64)})

    return run


def _packed(values: np.ndarray) -> tuple[bytes, bytes]:
    """Distinct values, and each one's place among them in as few bytes as there are."""
    distinct, at = np.unique(values, return_inverse=True)
    return distinct.tobytes(), at.astype(_index_type(len(distinct))).tobytes()


def _index_type(n: int):
    return np.uint8 if n <= 1 << 8 else np.uint16 if n <= 1 << 16 else np.uint32


def _places(table: np.ndarray, distinct: bytes, at: bytes) -> np.ndarray:
    """Places in the table of packed values."""
    values = np.frombuffer(distinct, np.uint64)
    return _found(table, values).astype(np.uint32)[np.frombuffer(at, _index_type(len(values)))]


def _runs(ascending: np.ndarray) -> tuple[bytes, bytes]:
    """Distinct values and how often each stands."""
    starts = np.flatnonzero(np.concatenate([[True], ascending[1:] != ascending[:-1]]))
    return ascending[starts].tobytes(), np.diff(np.append(starts, len(ascending))).astype(np.uint32).tobytes()


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split(" ")[0] for c in schema.split(", ")], dtype=object)


#: Kinds of dealt rows: counts of words, occurrences, and a slice's texts with the sums
#: that are final already.
_TOTALS, _OCCURRENCES, _TEXTS = 0, 1, 2


def _deal(model: Model):
    """Occurrences by bucket, several bytes each; frequent bigrams are settled here."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n_hot, part = len(model.hot_words), TaskContext.get().partitionId()
        for k, s in enumerate(Cutter().slices(batches)):
            w, c = model.known(s.words), model.known(s.contexts)
            pair = np.where((w >= 0) & (c >= 0), _found(model.hot_pairs, _pairs(c, w, n_hot)), -1)
            number, settled = (part << 32) + k, pair >= 0
            losses = model.losses(model.hot_counts[w[settled]], model.pair_counts[pair[settled]], ~s.last[settled])
            sums = _text_sums(losses, s.texts[settled], len(s.keys))
            rows: list[tuple] = [(number % model.buckets, _TEXTS, number, *[None] * 7, s.keys.tobytes(), sums.tobytes())]
            rest = np.flatnonzero(~settled)
            buckets = model.bucket(s.words[rest], s.contexts[rest], w[rest] >= 0)
            # In the order of words, a word of a bucket is named once.
            order = np.lexsort((s.words[rest], buckets))
            rest, buckets = rest[order], buckets[order]
            cuts = np.flatnonzero(np.diff(buckets)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(rest)]):
                if a == b:
                    continue
                at = rest[a:b]
                used, texts = np.unique(s.texts[at], return_inverse=True)
                marked = texts.astype(np.uint16) | (s.last[at].astype(np.uint16) << np.uint16(15))
                rows.append((
                    int(buckets[a]), _OCCURRENCES, number, *_runs(s.words[at]), *_packed(s.contexts[at]), marked.tobytes(),
                    used.astype(np.uint16).tobytes(), s.target[used].tobytes(), None, None,
                ))
            yield _frame(rows, _DEALT)

    return run


def _text_sums(losses: np.ndarray, texts: np.ndarray, n: int) -> np.ndarray:
    """Background and target loss and number of occurrences of each of n texts."""
    return np.column_stack([np.bincount(texts, losses[:, 0], n), np.bincount(texts, losses[:, 1], n), np.bincount(texts, minlength=n)])


def _deal_totals(model: Model):
    """Counts of words, each in its bucket; the frequent ones are known everywhere."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = batch["word"].to_numpy(dtype=np.int64).view(np.uint64)
            rare = (model.known(words) < 0) & (words != START)
            words, counts = words[rare], batch[list(_COUNTS)].to_numpy(dtype=float)[rare]
            buckets = model.bucket(words, words, np.zeros(len(words), dtype=bool))
            rows = []
            for bucket in np.unique(buckets):
                mine = buckets == bucket
                rows.append((int(bucket), _TOTALS, None, words[mine].tobytes(), *[None] * 7, counts[mine].tobytes()))
            yield _frame(rows, _DEALT)

    return run


def _score_buckets(model: Model):
    """Sums of losses by slice and bucket, from rows sorted by bucket and kind."""

    def scored(words: list, counts: list, dealt: list) -> Iterator[pd.DataFrame]:
        if not dealt:
            return
        table = np.concatenate([model.hot_words, *words])
        known = np.concatenate([model.hot_counts, *counts])
        order = np.argsort(table)
        table, known = table[order], known[order]
        words_of = [(_found(table, np.frombuffer(r.words, np.uint64)).astype(np.uint32), np.frombuffer(r.at, np.uint32)) for r in dealt]
        at = np.concatenate([np.repeat(w, n) for w, n in words_of])
        contexts = np.unique(np.concatenate([np.frombuffer(r.contexts, np.uint64) for r in dealt]))
        before = np.concatenate([_places(contexts, r.contexts, r.before) for r in dealt])
        pairs, which = np.unique(_pairs(before, at, len(table)), return_inverse=True)
        which, n_pairs = which.astype(np.uint32), len(pairs)
        del before, contexts, pairs
        marked = [np.frombuffer(r.texts, np.uint16) for r in dealt]
        first = np.cumsum([0, *(len(r.target) for r in dealt)])
        texts = np.concatenate([(m & 0x7FFF).astype(np.uint32) + np.uint32(f) for m, f in zip(marked, first)])
        going = np.concatenate([m < 0x8000 for m in marked])
        target = np.concatenate([np.frombuffer(r.target, bool) for r in dealt])
        counted = np.column_stack([np.bincount(which, minlength=n_pairs), np.bincount(which, target[texts], n_pairs)])
        sums = np.zeros((len(target), 3))
        for a in range(0, len(at), STEP_WORDS):
            part = slice(a, a + STEP_WORDS)
            losses = model.losses(known[at[part]], counted[which[part]], going[part])
            sums += _text_sums(losses, texts[part], len(target))
        yield _frame([(r.slice, None, r.used, sums[a:b].tobytes()) for r, a, b in zip(dealt, first, first[1:])], _SUMMED)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket, words, counts, dealt = None, [], [], []
        for batch in batches:
            for r in batch.itertuples(index=False):
                if r.bucket != bucket:
                    yield from scored(words, counts, dealt)
                    bucket, words, counts, dealt = r.bucket, [], [], []
                if r.kind == _TOTALS:
                    words.append(np.frombuffer(r.words, np.uint64))
                    counts.append(np.frombuffer(r.counts, float).reshape(-1, 4))
                elif r.kind == _OCCURRENCES:
                    dealt.append(r)
                else:
                    yield _frame([(r.slice, r.keys, None, r.counts)], _SUMMED)
        yield from scored(words, counts, dealt)

    return run


def _slice_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums by text, from rows sorted by slice, its texts first."""
    keys, sums, number = np.zeros(0, np.int64), np.zeros((0, 3)), None

    def done() -> pd.DataFrame:
        return pd.DataFrame({"key": keys, "background": sums[:, 0], "target": sums[:, 1], "n": sums[:, 2].astype(np.int64)})

    for batch in batches:
        for r in batch.itertuples(index=False):
            found = np.frombuffer(r.sums, float).reshape(-1, 3)
            if r.slice != number:
                yield done()
                number, keys, sums = r.slice, np.frombuffer(r.keys, np.int64), found.copy()
            else:
                sums[np.frombuffer(r.used, np.uint16)] += found
    yield done()


def score_by_counts(df: DataFrame, target_col: str, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Adds ``n_tokens``, ``target_loss``, ``background_loss`` and ``score`` by two
    bigram models of all words of ``df``; no word or bigram is merged or left out.

    The background counts every text, the target those with a true ``target_col``. A
    context's counts are interpolated with ``OWN`` pseudo-counts dealt by the
    frequencies of single words, which themselves get one more each, as does one unseen
    word; the background counts are scaled to the target's total. Losses are means per
    word in nats, the score is background less target.

    Words are told apart by 64-bit hashes. Each occurrence is dealt once, to the bucket
    of its word, in some twelve bytes; the bucket counts its bigrams and hands on one
    array of sums for each slice of texts. Bigrams of words too frequent for a bucket are spread by their context,
    and those bigrams that are too frequent themselves, at most four to a bucket, are
    counted before and settled where the text lies. So no bucket outgrows a task.
    Without a word (null, empty, blank texts) losses and score are null; equal texts have
    equal ones. ``carry`` names the columns kept (default all); columns of the new names
    are replaced; an empty table stays empty.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    chosen = F.coalesce(F.col(f"`{target_col}`"), F.lit(False)).cast("boolean")
    texts = df.select(F.xxhash64(text).alias("key"), text.alias("text"), chosen.alias("target"))
    counted = texts.mapInPandas(_word_counts, "word long, " + ", ".join(f"{c} long" for c in _COUNTS))
    counts = stage(counted.groupBy("word").agg(*[F.sum(c).alias(c) for c in _COUNTS]), "words")
    model, start = _model(texts, counts)
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), model.buckets // 2)
    dealt = counts.mapInPandas(_deal_totals(model), _DEALT).unionByName(texts.mapInPandas(_deal(model), _DEALT))
    ordered = dealt.repartition(parts, "bucket").sortWithinPartitions("bucket", "kind")
    by_bucket = ordered.mapInPandas(_score_buckets(model), _SUMMED)
    by_slice = by_bucket.repartition("slice").sortWithinPartitions("slice", F.col("keys").isNull())
    by_text = by_slice.mapInPandas(_slice_sums, "key long, background double, target double, n long")
    sums = by_text.groupBy("key").agg(*[F.sum(c).alias(f"_{c}") for c in ("background", "target", "n")])

    carry = [c for c in (df.columns if carry is None else carry) if c.lower() not in _NEW]
    row, key = unused("_row", carry), unused("_text", carry)
    sums = sums.select(F.col("key").alias(unused("_key", [row, key])), *[F.col(c) for c in ("_background", "_target", "_n")])
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in carry], word_count(text).alias("n_tokens")).alias(row), F.xxhash64(text).alias(key))
    joined = packed.join(sums, F.col(key) == F.col(sums.columns[0]), "left")
    # A text's first context is charged here: equal texts share one sum of all of them.
    n = F.col(row)["n_tokens"]
    b, t = (F.col(f"_{c}") / F.col("_n") + F.lit(start[k]) / F.nullif(n, F.lit(0)) for k, c in enumerate(("background", "target")))
    return joined.select(
        *[F.col(row)[c].alias(c) for c in carry], n.alias("n_tokens"), t.alias("target_loss"), b.alias("background_loss"), (b - t).alias("score")
    )


def _model(texts: DataFrame, counts: DataFrame) -> tuple[Model, tuple[float, float]]:
    """The model, and what the start of a text costs as a context in background and target."""
    total = counts.agg(F.sum("b").alias("b"), F.sum("t").alias("t"), F.count_if(F.col("b") > 0).alias("words")).first()
    size, target = total["b"] or 0, total["t"] or 0
    scale = target / max(size, 1)
    buckets = max(LEAST_BUCKETS, -(-size // BUCKET_WORDS))
    often = F.lit(size / (4 * buckets))
    # At most four words to a bucket are that frequent, and the start of texts.
    mark = int(START.view(np.int64))
    hot = counts.filter((F.col("b") > often) | (F.col("word") == mark)).collect()
    hot.sort(key=lambda r: int(np.int64(r["word"]).view(np.uint64)))
    hot_words = np.array([r["word"] for r in hot], dtype=np.int64).view(np.uint64)
    hot_counts = np.array([[r[c] for c in _COUNTS] for r in hot], dtype=float).reshape(-1, 4)
    started = next(([r["cb"], r["ct"]] for r in hot if r["word"] == mark), [0, 0])
    none = np.zeros(0, dtype=np.int64), np.zeros((0, 2))
    model = Model(buckets, total["words"], float(target), scale, hot_words, hot_counts, *none)
    if len(hot) > 1:
        found = texts.mapInPandas(_hot_pair_counts(model), "pair long, b long, t long")
        frequent = found.groupBy("pair").agg(F.sum("b").alias("b"), F.sum("t").alias("t")).filter(F.col("b") > often)
        # At most four bigrams to a bucket.
        pairs = sorted(frequent.collect(), key=lambda r: r["pair"])
        model = Model(
            buckets, total["words"], float(target), scale, hot_words, hot_counts,
            np.array([r["pair"] for r in pairs], dtype=np.int64), np.array([[r["b"], r["t"]] for r in pairs], dtype=float).reshape(-1, 2),
        )
    return model, (math.log(scale * started[0] + OWN), math.log(started[1] + OWN))
