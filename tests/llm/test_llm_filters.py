"""URL rules, quality rules, mixing and sharding against plain Python."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from beforeafter.llm import mixing, quality_rules, queries, sharding, text, url_rules

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, size long, uid long, _m string, _p int, kept string"
LONG = " ".join(f"w{i % 997}x{i % 89}" for i in range(30_000))


def clash(doc_id, body, source="a"):
    return (doc_id, body, "en", source, 1, "r", 77, 5, "m", 6, "k")


ODD = [
    clash(1, None),
    clash(2, ""),
    clash(3, " \n\t "),
    clash(None, "a text without an id, of some words"),
    clash(4, LONG, None),
    clash(5, "same words " * 12, "b"),
    clash(5, "same words " * 12, "b"),
    clash(6, "x", None),
    clash(7, "É\x0bÀ  é\x0c1 # b\nb\n\nb", "b"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


def words(body):
    return re.findall(r"[^\x20\x09-\x0D]+", body or "")


def measured(body):
    body = body or ""
    w, seen, marked = words(body), {}, set()
    for i in range(len(w) - 7):
        key = tuple(w[i : i + 8])
        if key in seen:
            marked.update(range(i, i + 8), range(seen[key], seen[key] + 8))
        else:
            seen[key] = i
    lines = [x for x in body.split("\n") if words(x)]
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", body)), len(lines) - len(set(lines)), len(marked),
        sum(c.isupper() for c in body), body.count("!"), len(set(w)),
    )


def by_hand(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fitting = [
        (len(r), r, v) for r, v in rules
        if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[len(r.split("/")[0]) :])
    ]
    _, rule, verdict = max(fitting, default=(0, None, "allow"))
    return host, path, rule, verdict


RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"), ("a.b/pre", "block"), ("b", "block")]
URLS = [
    None, "", "no scheme", "http://", "http://NET/", "http://x.net", "https://Example.NET/en/1?net/", "http://example.net/En/", "ftp://fakeexample.com/de/x",
    "x://example.com/de/#f", "x://m.example.com/de", "http://a.org/fr/?q", "http://a.org#/fr/", "http://a.b/prefix", "http://a.b/pr", "http://b",
    "http://É.net/ü?x", "http://u@example.net/en/", "://net/", "http://a://net/", "http://x.net/" + "p/" * 20_000, "http://net/\n/en", "http://x.net/", "http://x.net/",
]


def test_url_rules_equal_a_plain_reading(spark, rows):
    urls = spark.createDataFrame([(i, u, "h", "t") for i, u in enumerate(URLS)], "page_id long, url string, host string, _uid string")
    rules = spark.createDataFrame(RULES, "rule string, verdict string")
    got = url_rules.judge(urls, rules)
    assert got.columns == ["page_id", "url", "_uid", "host", "path", "rule", "verdict"]
    # A rule without a path is a host alone: nothing but a slash or the end may follow.
    want = [(i, *by_hand(u, RULES)) for i, u in enumerate(URLS)]
    assert rows(got, "page_id", "host", "path", "rule", "verdict") == sorted(want, key=repr)


def test_url_rules_with_wildcards_no_rules_and_no_rows(spark, rows):
    urls = spark.createDataFrame([("http://ads7.x.com/a",), ("http://x.com/q/ad/1",), ("http://x.com/",)], "url string")
    rules = spark.createDataFrame([("ads*.x.com/", "block"), ("x.com/*/ad/", "block"), (None, "block")], "rule string, verdict string")
    assert rows(url_rules.judge(urls, rules), "rule") == [("ads*.x.com/",), ("x.com/*/ad/",), (None,)]
    index = url_rules.indexed(url_rules.compiled(rules), urls.select(F.array(F.lit("x"), F.lit("com")).alias("tokens")))
    assert rows(index, "rule", "token") == [("ads*.x.com/", "com"), ("x.com/*/ad/", "ad")]
    assert url_rules.judge(urls, rules.limit(0)).filter("verdict = 'allow'").count() == 3
    assert url_rules.judge(urls.limit(0), rules).count() == 0


def test_measures_equal_a_plain_count(odd, spark, sf_dir):
    docs = odd.select("doc_id", "text").unionByName(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    got = docs.select("text", quality_rules.measures(F.col("text")).alias("m")).collect()
    assert all(tuple(r["m"]) == measured(r["text"]) for r in got)


def test_quality_rules_keep_every_row_and_its_columns(odd):
    got = quality_rules.judge_quality(odd)
    assert [c for c in odd.columns if c != "kept"] == got.columns[: len(odd.columns) - 1]
    out = got.collect()
    assert len(out) == len(ODD) and all(r["_m"] == "m" for r in out)
    assert all(r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]) for r in out)
    assert not any(r["kept"] for r in out if r["base_failed"])
    assert quality_rules.judge_quality(odd.limit(0)).count() == 0


def test_votes_tell_planted_faults_from_good_rows():
    """Three kinds of fault, each seen by its own rule or two; a rule with false alarms."""
    patterns = Counter({(1, 1, 1, 1): 9_000, (-1, 1, 1, 1): 300, (1, -1, -1, 1): 400, (1, 1, -1, 1): 30, (0, 1, 1, 1): 500})
    model = quality_rules.estimate(sorted(patterns.items()), 4)

    def good(votes):
        parts = []
        for prior, chances in zip(model.priors, model.chances):
            for j, v in enumerate(votes):
                prior *= chances[j][v + 1]
            parts.append(prior)
        return parts[0] / sum(parts)

    assert good((1, 1, 1, 1)) > 0.99 and good((0, 1, 1, 1)) > 0.9
    assert good((-1, 1, 1, 1)) < 0.1 and good((1, -1, -1, 1)) < 0.01
    assert all(0.5 < a <= 1 for a in model.accuracy)


def test_good_votes_outweigh_a_rule_with_frequent_false_alarms():
    """Seven rules see a kind of fault each; the eighth votes bad on a fifth of all rows."""
    for size in (100, 10_000):
        patterns = Counter()
        for fault in range(-1, 7):
            votes = [-1 if j == fault else 1 for j in range(7)]
            n = size * (86 if fault < 0 else 2)
            patterns[(*votes, 1)] += n * 4 // 5
            patterns[(*votes, -1)] += n // 5
        model = quality_rules.estimate(sorted(patterns.items()), 8)

        def good(votes):
            parts = [p * np.prod([c[j][v + 1] for j, v in enumerate(votes)]) for p, c in zip(model.priors, model.chances)]
            return parts[0] / sum(parts)

        assert good((1,) * 7 + (-1,)) > 0.5
        assert good((-1,) + (1,) * 7) < 0.1 and good((-1,) + (1,) * 6 + (-1,)) < 0.1
        assert model.chances[0][7][0] == pytest.approx(0.2, abs=0.05)


def test_hits_on_a_rules_own_faults_are_estimated():
    """Two rules see one kind of fault, the first of them four times in five."""
    patterns = {(1, 1, 1): 90_000, (-1, -1, 1): 8_000, (1, -1, 1): 2_000, (1, 1, -1): 500}
    model = quality_rules.estimate(sorted(patterns.items()), 3)
    hits = [model.chances[j + 1][j] for j in range(3)]
    assert any(h != pytest.approx(quality_rules.OWN_FAULT) for h in hits) and all(h[0] >= 0.5 for h in hits)


def test_posterior_column_equals_the_model(spark):
    patterns = [((1, -1), 3), ((0, 1), 5), ((-1, 0), 1)]
    model = quality_rules.estimate(patterns, 2)
    got = spark.createDataFrame([(list(p),) for p, _ in patterns], "votes array<tinyint>").select(model.posterior(F.col("votes"))).collect()
    for (votes, _), r in zip(patterns, got):
        parts = [p * c[0][votes[0] + 1] * c[1][votes[1] + 1] for p, c in zip(model.priors, model.chances)]
        assert r[0] == pytest.approx(parts[0] / sum(parts))


def filled(sizes, weights, share, epochs):
    left, open_, target = share * sum(sizes.values()), set(sizes), {}
    while open_:
        total = sum(weights[s] for s in open_)
        full = {s for s in open_ if left * weights[s] / total >= epochs * sizes[s]}
        if not full:
            target |= {s: left * weights[s] / total for s in open_}
            break
        for s in full:
            target[s] = epochs * sizes[s]
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


def test_mixture_reaches_its_targets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mixed = mixing.mix(docs, text.word_count(F.col("text")))
    out = mixed.collect()
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in out:
        assert r["size"] == len(words(r["text"])) and 0 <= r["copies"] <= 2
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes))}
    want = filled(sizes, weights, 1.5, 2.0)
    for r in out:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)
    again = mixing.mix(docs.repartition(5), text.word_count(F.col("text")))
    key = lambda rows: sorted((r["doc_id"], r["copies"]) for r in rows)
    assert key(out) == key(again.collect())
    assert mixing.repeated(mixed, docs.columns).count() == sum(r["copies"] for r in out)


def test_mixture_of_odd_rows(odd, spark):
    mixed = mixing.mix(odd, text.word_count(F.col("text")))
    assert mixed.columns == [c for c in odd.columns if c != "size"] + ["size", "source_size", "target", "copies"]
    out = mixed.collect()
    assert len(out) == len(ODD) and all(r["row"] == "r" and r["uid"] == 5 for r in out)
    assert sum(r["target"] for r in {r["source"]: r for r in out}.values()) == pytest.approx(1.5 * sum(r["size"] for r in out))
    assert mixing.mix(odd.limit(0), F.lit(1)).count() == 0
    assert mixing.mix(odd.filter("text IS NULL"), text.word_count(F.col("text"))).first()["target"] == 0


def test_permutation_and_its_inverse(spark):
    for n in (1, 2, 3, 7, 64, 1000, 4099):
        rows = spark.range(n).select("id", sharding.permuted("id", n, 17).alias("p"))
        back = rows.select("id", "p", sharding.permuted("p", n, 17, inverse=True).alias("b")).collect()
        assert sorted(r["p"] for r in back) == list(range(n)) and all(r["b"] == r["id"] for r in back)


def test_shards_are_even_gapless_and_can_be_looked_up(odd, spark):
    for df in (odd, spark.range(1003).withColumnRenamed("id", "doc_id")):
        out = sharding.shards(df, 8, [F.col("doc_id").asc_nulls_first()])
        slots = defaultdict(list)
        for r in out.collect():
            slots[r["shard"]].append(r["slot"])
        counts = [len(slots[k]) for k in range(8)]
        assert sum(counts) == df.count() and max(counts) - min(counts) <= 1
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        found = sharding.row_in_slot(out.select("shard", "slot", F.col("row_no").alias("was")), sum(counts), 8)
        assert all(r["row_no"] == r["was"] for r in found.collect())
    assert sharding.shards(odd.limit(0), 8, [F.col("doc_id").asc()]).count() == 0
    again = [sharding.shards(spark.range(500).repartition(k), 8, [F.col("id").asc()]) for k in (1, 7)]
    a, b = (sorted(map(tuple, x.select("id", "shard", "slot").collect())) for x in again)
    assert a == b


def test_sharding_query_sizes_and_checksums(spark, sf_dir):
    from beforeafter.llm.queries import op9_sharding

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in op9_sharding(spark, sf_dir).collect():
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "rows", None)


def test_queries_equal_their_sql(spark, sf_dir):
    from check_oracle import compare, connect, plain

    from beforeafter.llm.oracle import ORACLE
    from beforeafter.llm.queries import QUERIES

    con = connect(sf_dir)
    for name, sql in ORACLE.items():
        assert compare(plain(QUERIES[name](spark, sf_dir).toPandas()), plain(con.execute(sql).df())) == ""


def test_verdicts_move_smoothly_with_the_votes_seen():
    """A rule votes bad on a fifth of all rows, another on ever more of them at random."""
    posteriors = []
    for seen in [0, 1, 5, 10, 20, *range(40, 61), 80, 100, 1_000, 3_000]:
        patterns: Counter = Counter()
        for k in range(10_000):
            picked = seen and (k * seen) % 10_000 < seen
            patterns[(1, -1 if picked else 1, 1, -1 if k % 5 == 0 else 1)] += 1
        model = quality_rules.estimate(sorted(patterns.items()), 4)
        parts = [p * np.prod([c[j][v + 1] for j, v in enumerate((1, 1, 1, -1))]) for p, c in zip(model.priors, model.chances)]
        posteriors.append(parts[0] / sum(parts))
    near = posteriors[5:26]
    assert max(abs(a - b) for a, b in zip(near, near[1:])) < 0.05
    assert posteriors[0] < 0.05 and posteriors[-1] > 0.9


def em_by_rows(votes):
    """The same model worked out over rows, one at a time, in plain loops."""
    n_rules, belief = len(votes[0]), quality_rules.BELIEF_ROWS
    own, on_good, even = quality_rules.OWN_FAULT, quality_rules.ON_GOOD, quality_rules.EVEN_VOTES
    total = len(votes)
    given = [sum(v[j] < 0 for v in votes) for j in range(n_rules)]
    alarms = []
    for j in range(n_rules):
        overall = math.log(max(given[j] / total, on_good[0]))
        least = overall
        for k in range(n_rules):
            if k != j:
                both = sum(v[j] < 0 and v[k] < 0 for v in votes)
                share = math.log((both + belief * on_good[0]) / (given[k] + belief))
                w = given[k] / (given[k] + even)
                least = min(least, w * share + (1 - w) * overall)
        others = sum(given) - given[j]
        w = others / (others + even)
        alarms.append(math.exp((1 - w) * math.log(on_good[0]) + w * least))

    def added(c, j):
        if c == 0:
            return [1.0] + [belief * x / sum(on_good[1:]) for x in on_good[1:]]
        return [belief * x for x in own] if c == j + 1 else [1.0, 1.0, 1.0]

    def finished(sums):
        out = []
        for c in range(n_rules + 1):
            out.append([])
            for j in range(n_rules):
                s = sums[c][j]
                s = [x / sum(s) for x in s]
                if c == 0:
                    s = [alarms[j], *[x * (1 - alarms[j]) / sum(s[1:]) for x in s[1:]]]
                elif c == j + 1 and s[0] < quality_rules.LEAST_HIT:
                    low = quality_rules.LEAST_HIT
                    s = [low, *[x * (1 - low) / sum(s[1:]) for x in s[1:]]]
                out[c].append(s)
        return out

    sums = [[added(c, j) for j in range(n_rules)] for c in range(n_rules + 1)]
    for v in votes:
        held = [all(x >= 0 for x in v)] + [x < 0 for x in v]
        for c, h in enumerate(held):
            for j, x in enumerate(v):
                sums[c][j][x + 1] += h
    chances = finished(sums)
    for j in range(n_rules):
        chances[j + 1][j] = list(own)
    fault = [max(g / total - a, 0) * total + 1 for g, a in zip(given, alarms)]
    priors = [max(total - sum(fault), 0) + 1, *fault]
    priors = [p / sum(priors) for p in priors]
    before = None
    while True:
        known: dict = {}
        for v in votes:
            if v not in known:
                parts = [p * math.prod(c[j][x + 1] for j, x in enumerate(v)) for p, c in zip(priors, chances)]
                known[v] = [p / sum(parts) for p in parts]
        if before is not None and max(abs(a - b) for v in known for a, b in zip(known[v], before[v])) < 1e-8:
            return known
        before = known
        sums = [[added(c, j) for j in range(n_rules)] for c in range(n_rules + 1)]
        priors = [1.0] * (n_rules + 1)
        for v in votes:
            for c, h in enumerate(known[v]):
                priors[c] += h
                for j, x in enumerate(v):
                    sums[c][j][x + 1] += h
        priors = [p / sum(priors) for p in priors]
        chances = finished(sums)


def votes_by_hand(m):
    n, chars, symbols, lines, repeats, capitals, shouts, distinct = m
    if not n:
        return (0,) * 8
    rules = [
        (n < 20, 50 <= n <= 100_000), (not 3 * n <= chars <= 10 * n, 3.5 * n <= chars <= 7 * n), (symbols > 0.1 * n, symbols <= 0.02 * n),
        (lines > 0.1 * n, lines <= 0.02 * n), (repeats > 0.3 * n, repeats <= 0.1 * n), (capitals > 0.3 * chars, capitals <= 0.1 * chars),
        (shouts > 0.3 * n, shouts <= 0.05 * n), (distinct < 0.2 * n and 20 <= n <= 5000, distinct >= 0.4 * n),
    ]
    return tuple(-1 if bad else 1 if good else 0 for bad, good in rules)


def test_quality_query_equals_estimates_over_rows(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    by_hand = {i: measured(t) for i, t in docs}
    votes = {i: votes_by_hand(m) for i, m in by_hand.items()}
    posterior = em_by_rows([votes[i] for i, _ in docs])
    kept = {
        i: not (m[0] < 20 or 100 * m[4] > 30 * m[0]) and posterior[votes[i]][0] >= 0.5 for i, m in by_hand.items()
    }
    got = queries.op5_quality_rules(spark, sf_dir).collect()
    assert {r["doc_id"]: r["kept"] for r in got} == kept and len(got) == len(docs)
    assert all(abs(r["posterior"] - posterior[votes[r["doc_id"]]][0]) < 1e-4 for r in got)
