"""Byte-level BPE: whole pre-tokens by a minimal perfect hash, the rest by a heap."""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beforeafter.llm.text import unused


class PerfectHash:
    """Distinct byte strings in as many slots as there are strings, none left empty.

    Hash and displace: keys fall into buckets, and each bucket, largest first, gets
    the least seed that throws all its keys into free slots; a bucket of one key names
    its slot outright. Looking up takes two hashes and one comparison.
    """

    def __init__(self, keys: list[bytes], values: list[int]):
        n = len(keys)
        if len(set(keys)) != n:
            raise ValueError("keys repeat")
        buckets: list[list[int]] = [[] for _ in range(max(1, n // 3))]
        for i, key in enumerate(keys):
            buckets[xxhash.xxh64_intdigest(key, 0) % len(buckets)].append(i)
        slots, self.seeds = [-1] * n, array("q", [0] * len(buckets))
        order = sorted((b for b in range(len(buckets)) if buckets[b]), key=lambda b: -len(buckets[b]))
        several = [b for b in order if len(buckets[b]) > 1]
        for b in several:
            seed = 1
            while True:
                tried = [xxhash.xxh64_intdigest(keys[i], seed) % n for i in buckets[b]]
                if len(set(tried)) == len(tried) and all(slots[s] < 0 for s in tried):
                    break
                seed += 1
            self.seeds[b] = seed
            for i, s in zip(buckets[b], tried):
                slots[s] = i
        free = (s for s in range(n) if slots[s] < 0)
        for b in order[len(several) :]:
            s = next(free)
            self.seeds[b] = -1 - s
            slots[s] = buckets[b][0]
        self.keys = [keys[i] for i in slots]
        self.values = array("q", [values[i] for i in slots])

    def get(self, key: bytes) -> int:
        """The key's value, or -1."""
        if not self.keys:
            return -1
        seed = self.seeds[xxhash.xxh64_intdigest(key, 0) % len(self.seeds)]
        slot = -1 - seed if seed < 0 else xxhash.xxh64_intdigest(key, seed) % len(self.keys)
        return self.values[slot] if self.keys[slot] == key else -1


#: Most pre-tokens remembered by a worker (some 60 MB), and the longest of them. What
#: is forgotten is worked out anew.
REMEMBERED = 1 << 18
REMEMBERED_LENGTH = 48
#: Rows of a batch whose ids and bytes are gathered at a time.
SLICE = 512


class Tokenizer:
    """Ranks (``token`` to id) and the pattern that cuts texts into pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.table = PerfectHash(list(ranks), list(ranks.values()))
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, i in ranks.items():
            self.bytes_of[i] = token
        self.pattern = pattern
        self.split, self.known = regex.compile(pattern).findall, {}

    def merged(self, piece: bytes) -> list[int]:
        """Ids of a pre-token outside the vocabulary.

        Bytes are linked to their right and left neighbours; a heap gives the pair of
        least rank, the leftmost first, which merges. A pair that a merge has changed
        is skipped when it comes up, so n bytes take O(n log n).
        """
        rank, n = self.ranks.get, len(piece)
        after, before = list(range(1, n + 2)), list(range(-1, n))
        heap = []
        for i in range(n - 1):
            r = rank(piece[i : i + 2])
            if r is not None:
                heap.append((r, i, i + 2))
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            _, i, k = pop(heap)
            j = after[i]
            if j >= k or after[j] != k:  # i has merged away or grown, or its right has
                continue
            after[i] = k
            after[j] = n + 1
            if k < n:
                before[k] = i
                r = rank(piece[i : after[k]])
                if r is not None:
                    push(heap, (r, i, after[k]))
            h = before[i]
            if h >= 0:
                r = rank(piece[h:k])
                if r is not None:
                    push(heap, (r, h, k))
        ids, i = [], 0
        while i < n:
            ids.append(rank(piece[i : after[i]]))
            i = after[i]
        return ids

    def piece(self, text: str) -> bytes:
        """Ids of one pre-token, four bytes each."""
        key = text.encode()
        whole = self.table.get(key)
        got = np.array([whole] if whole >= 0 else self.merged(key), dtype="<i4").tobytes()
        if len(text) <= REMEMBERED_LENGTH:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[text] = got
        return got

    def encode(self, text: str) -> bytes:
        """Ids of a text, four bytes each."""
        known, piece = self.known.get, self.piece
        return b"".join([known(t) or piece(t) for t in self.split(text)])

    def decode(self, ids: bytes) -> bytes:
        """What ``encode`` was given, in UTF-8."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<i4").tolist()))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("known", "split")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.split, self.known = regex.compile(self.pattern).findall, {}


def read_ranks(path: str) -> dict[bytes, int]:
    """Lines of a base64 token and its rank; read on the driver, megabytes at most."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


@lru_cache(maxsize=4)
def tokenizer(path: str, pattern: str) -> Tokenizer:
    return Tokenizer(read_ranks(path), pattern)


def _lists(parts: list[bytes]) -> pa.Array:
    """Lists of ints from their bytes, without a Python object per id."""
    ends = np.cumsum([0, *(len(p) // 4 for p in parts)])
    flat = np.frombuffer(b"".join(parts), dtype="<i4")
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))


def encode(df: DataFrame, path: str, pattern: str, text_col: str = "text", name: str = "ids") -> DataFrame:
    """Adds ``name``, the ids (array of int) of the whole text; null counts as empty.

    The vocabulary is broadcast: as many entries as the rank file has, whatever the
    table. Special tokens are ordinary text. Row by row, so nothing shuffles.
    """
    held = df.sparkSession.sparkContext.broadcast(tokenizer(path, pattern))

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for at in range(0, len(texts), SLICE):
                yield _lists([held.value.encode(t) for t in texts.slice(at, SLICE).to_pylist()])

    return df.withColumn(name, ids(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))


def round_trip(
    df: DataFrame, path: str, pattern: str, text_col: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``encode`` and ``decode`` in one pass: adds the ids and the bytes they stand for,
    so that ids do not travel to a second set of workers with a vocabulary of its own."""
    held = df.sparkSession.sparkContext.broadcast(tokenizer(path, pattern))

    @F.arrow_udf("ids array<int>, decoded binary")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = held.value
        for texts in batches:
            for at in range(0, len(texts), SLICE):
                parts = [coder.encode(t) for t in texts.slice(at, SLICE).to_pylist()]
                back = pa.array([coder.decode(p) for p in parts], pa.binary())
                yield pa.StructArray.from_arrays([_lists(parts), back], names=["ids", "decoded"])

    name = unused("_coded", df.columns)
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in (ids.lower(), decoded.lower())]
    coded = df.withColumn(name, both(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))
    return coded.select(*kept, F.col(name)["ids"].alias(ids), F.col(name)["decoded"].alias(decoded))


def decode(df: DataFrame, path: str, pattern: str, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """Adds ``name``, the bytes (binary) that the ids stand for; null for null ids.
    An id outside the vocabulary raises."""
    held = df.sparkSession.sparkContext.broadcast(tokenizer(path, pattern))

    @F.arrow_udf("binary")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of = held.value.bytes_of.__getitem__
        for lists in batches:
            flat, at = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            if len(flat) and flat.min() < 0:
                raise ValueError("negative token id")
            known = lists.is_valid().to_pylist()
            for first in range(0, len(lists), SLICE):
                # Row by row: a batch's ids as Python objects would take ten times its size.
                last = min(first + SLICE, len(lists))
                rows = [b"".join(map(of, flat[at[i] : at[i + 1]].tolist())) if known[i] else None for i in range(first, last)]
                yield pa.array(rows, pa.binary())

    return df.withColumn(name, text(F.col(f"`{ids_col}`")))
