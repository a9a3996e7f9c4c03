"""The corpus pipeline: every stage on odd tables, and all of it against plain Python."""

import math
import os
import re
import struct
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from test_llm_filters import em_by_rows, filled, measured, votes_by_hand

import corpus_pipeline
from beforeafter.llm import bpe, quality_classifier
from beforeafter.staging import run_dir, scope, stage

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name, run_stage", corpus_pipeline.STAGES)
def test_stages_on_odd_documents(spark, sf_dir, name, run_stage):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    odd = spark.createDataFrame(
        [(None, None, None, None, None, 1.0), (None, "", None, "s", 0, 2.0), (900_000, "w " * 50_000, "en", None, 1, 3.0)] * 2,
        "doc_id long, text string, lang string, source string, n_chars long, score double",
    )
    both = docs.unionByName(odd, allowMissingColumns=True)
    for column in ("_t", "_b", "_hash", "_score", "row", "uid", "copies", "kept", "fp", "ids", "size", "votes"):
        both = both.withColumn(column, F.lit("own"))
    out = run_stage(spark, both, sf_dir)
    if name == "tokens":
        assert out.count() == both.count() and out.filter("n_tokens IS NULL").isEmpty()
    else:
        assert out.columns == both.columns and out.filter("_hash != 'own' OR copies != 'own'").isEmpty()
        assert out.select("doc_id").exceptAll(both.select("doc_id").unionAll(both.select("doc_id"))).isEmpty()
    assert run_stage(spark, both.limit(0), sf_dir).count() == 0


def neighbours_score(voters, text):
    counts = quality_classifier.counts(text)
    if counts is None:
        return 0.0
    cosines = voters.vectors @ voters.latent(counts[None, :])[0]
    near = sorted(range(len(cosines)), key=lambda i: -cosines[i])[: quality_classifier.NEIGHBOURS]
    weight = [max(float(cosines[i]), 0.0) for i in near]
    return sum(w * voters.labels[i] for w, i in zip(weight, near)) / sum(weight) if sum(weight) else 0.0


def simhash_by_hand(text):
    words = WORD.findall(text or "")
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def one_of_each_by_hand(docs):
    """Ids of the least document of each component, over all pairs."""
    fps = {i: simhash_by_hand(t) for i, (t, _) in docs.items()}
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(docs)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i for i in ids if find(i) == i}


def taken_sizes_by_hand(docs):
    """For each source, the sizes of the documents it takes, repeats included, sorted."""
    by_source = defaultdict(list)
    for t, s in docs.values():
        by_source[s].append(len(WORD.findall(t or "")))
    sizes = {s: sum(v) for s, v in by_source.items()}
    weights = dict(zip(sorted(sizes), [5.0, 2.0, 1.0] * len(sizes)))
    target = filled(sizes, weights, 1.5, 2.0)
    out = {}
    for s, found in by_source.items():
        epochs = target[s] / sizes[s]
        seed = xxhash.xxh64_intdigest(struct.pack("<i", 23), xxhash.xxh64_intdigest(s.encode(), 42))
        start = ((seed - (1 << 64) if seed >> 63 else seed) % (1 << 30)) / (1 << 30)
        tries = []
        for k in range(16):
            u = (start + k / 16) % 1.0
            copies = [math.floor(epochs * (r + 1) + u) - math.floor(epochs * r + u) for r in range(len(found))]
            tries.append((abs(sum(c * n for c, n in zip(copies, sorted(found))) - target[s]), k, copies))
        copies = min(tries)[2]
        out[s] = sorted(n for c, n in zip(copies, sorted(found)) for _ in range(c))
    return out


def test_run_equals_all_stages_worked_out_plainly(spark, sf_dir):
    table, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    docs = {r["doc_id"]: (r["text"], r["source"]) for r in table.collect()}
    voters = quality_classifier.fit(table, labels)
    docs = {i: d for i, d in docs.items() if neighbours_score(voters, d[0]) >= 0.7}
    by_hand = {i: measured(t) for i, (t, _) in docs.items()}
    posterior = em_by_rows([votes_by_hand(m) for m in by_hand.values()])
    docs = {
        i: d for i, d in docs.items()
        if not (by_hand[i][0] < 20 or 100 * by_hand[i][4] > 30 * by_hand[i][0]) and posterior[votes_by_hand(by_hand[i])][0] >= 0.5
    }
    docs = {i: docs[i] for i in one_of_each_by_hand(docs)}
    sizes = taken_sizes_by_hand(docs)
    result = corpus_pipeline.run(spark, sf_dir).collect()

    assert len(docs) > 20 and {r["doc_id"] for r in result} <= set(docs)
    got = defaultdict(list)
    for r in result:
        assert r["source"] == docs[r["doc_id"]][1]
        got[r["source"]].append(len(WORD.findall(docs[r["doc_id"]][0])))
    assert {s: sorted(v) for s, v in got.items()} == {s: v for s, v in sizes.items() if v}
    assert max(Counter(r["doc_id"] for r in result).values()) <= 2
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    plain = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in result:
        assert r["ids"] == plain.encode_ordinary(docs[r["doc_id"]][0]) and r["n_tokens"] == len(r["ids"])


def test_run_leaves_one_stage_behind(spark, sf_dir):
    root = run_dir(spark).removeprefix("file:")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    corpus_pipeline.run(spark, sf_dir)
    new = set(os.listdir(root)) - before
    assert len(new) == 1 and os.listdir(f"{root}/{new.pop()}") == ["mixing"]


def test_a_scope_deletes_what_it_staged(spark):
    outside = stage(spark.range(3), "outside")
    with scope(spark):
        inside = stage(spark.range(4), "inside")
        assert inside.count() == 4
    assert outside.count() == 3
    with pytest.raises(Exception):
        spark.read.parquet(inside.inputFiles()[0]).count()
