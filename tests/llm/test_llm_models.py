"""LM scoring, HTML extraction, tokens, the quality classifier and the pipeline."""

import hashlib
import random

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from beforeafter.llm import bpe, html_text, lm_scoring, quality_classifier
from beforeafter.llm import queries as Q

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = [None, "", " \n\t", "x", "É%%% !!", "word " * 40_000, "same", "same"]


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    return bpe.tokenizer(PATH, public_tokenizers.PATTERN)


def test_perfect_hash_is_minimal_and_exact():
    keys = [b"%d" % i for i in range(5_000)]
    table = bpe.PerfectHash(keys, list(range(5_000)))
    assert len(table.keys) == 5_000 and all(table.get(k) == i for i, k in enumerate(keys))
    assert table.get(b"x") == table.get(b"") == -1
    assert bpe.PerfectHash([], []).get(b"a") == -1 and bpe.PerfectHash([b"a"], [3]).get(b"a") == 3
    with pytest.raises(ValueError):
        bpe.PerfectHash([b"a", b"a"], [1, 2])


def test_tokens_equal_those_of_the_public_library(tokenizer, reference):
    rng = random.Random(6)
    pools = [range(1, 0x250), range(0x20, 0x7F), range(0x4E00, 0x9FFF), range(0x1F600, 0x1F640), [32, 10, 9, 13, 0x1C, 0x85, 0xA0, 0x2009, 0x300, 0xB2]]
    texts = ["".join(chr(rng.choice(rng.choice(pools))) for _ in range(rng.randint(0, 90))) for _ in range(800)]
    texts += ["<|endoftext|>", "it's I'LL 12 345", "ab" * 20_000, " " * 5_000, "aaaaab" * 5_000, "\n\n  x"]
    for t in texts:
        ids = np.frombuffer(tokenizer.encode(t), "<i4").tolist()
        assert ids == reference.encode_ordinary(t), repr(t[:80])
        assert b"".join(tokenizer.bytes_of[i] for i in ids).decode() == t


def test_forgetting_changes_nothing(tokenizer, monkeypatch, reference):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    t = " ".join(f"xq{i % 11}zzy" for i in range(300))
    assert np.frombuffer(tokenizer.encode(t), "<i4").tolist() == reference.encode_ordinary(t)


def test_encode_and_decode_frames(spark, reference):
    df = spark.createDataFrame([(i, t, "old") for i, t in enumerate(ODD)], "doc_id int, text string, ids string")
    coded = bpe.decode(bpe.encode(df, PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN)
    for r in coded.collect():
        assert r["ids"] == reference.encode_ordinary(r["text"] or "") and bytes(r["decoded"]).decode() == (r["text"] or "")
    once = bpe.round_trip(df, PATH, public_tokenizers.PATTERN)
    assert once.columns == coded.columns[:2] + ["ids", "decoded"]
    key = lambda rows: sorted((r["doc_id"], r["ids"], bytes(r["decoded"])) for r in rows)
    assert key(once.collect()) == key(coded.collect()) and bpe.round_trip(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
    assert bpe.encode(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
    null = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert sorted((r["decoded"] for r in bpe.decode(null, PATH, public_tokenizers.PATTERN).collect()), key=repr) == [None, b""]


def test_token_query_digests(spark, sf_dir, reference):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in Q.op6_bpe(spark, sf_dir).collect():
        ids = reference.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def plain_scores(texts, is_target):
    """Losses by dictionaries of all words and bigrams."""
    from collections import Counter
    from math import log

    words = [(t or "").encode().lower().split() for t in texts]
    pairs = [list(zip([None, *w], w)) for w in words]
    models = []
    for chosen in (is_target, [True] * len(texts)):
        models.append(Counter(p for ps, yes in zip(pairs, chosen) if yes for p in ps))
    n_words = len({w for ws in words for w in ws})
    target, everything = (sum(m.values()) for m in models)
    losses = []
    for model, scale in zip(models, (1.0, target / max(everything, 1))):
        single, context = Counter(), Counter()
        for (c, w), n in model.items():
            single[w] += n
            context[c] += n
        own = lm_scoring.OWN
        losses.append(lambda c, w, m=model, s=scale, one=single, total=context: -log(
            (s * m[c, w] + own * (s * one[w] + 1) / (target + n_words + 1)) / (s * total[c] + own)
        ))
    return [[len(ps)] + [sum(f(*p) for p in ps) / len(ps) if ps else None for f in losses] for ps in pairs]


def test_every_word_and_bigram_counts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1")
    good = {r["doc_id"] for r in labels.filter(~quality_classifier.held_out(F.col("doc_id"))).collect()}
    want = dict(zip((r["doc_id"] for r in docs), plain_scores([r["text"] for r in docs], [r["doc_id"] in good for r in docs])))
    got = Q.op2_lm_scoring(spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        n, target, background = want[r["doc_id"]]
        assert r["n_tokens"] == n and (r["score"] is None) == (n == 0)
        assert n == 0 or (r["target_loss"], r["background_loss"]) == (pytest.approx(target), pytest.approx(background))


@pytest.mark.parametrize("bucket_words, texts, words", [(2_000, 7, 50), (100, 1, 1), (10**9, 16_384, 10**6)])
def test_buckets_and_slices_change_nothing(spark, monkeypatch, bucket_words, texts, words):
    """Frequent words and bigrams, few and many buckets, and texts that fill a slice alone."""
    rng = random.Random(4)
    some = [f"w{int(rng.paretovariate(0.6)) % 4000}" for _ in range(30_000)]
    docs = [" ".join(some[i : i + rng.randint(1, 90)]) for i in range(0, 30_000, 60)]
    docs += ["of the", "of the of the of the", "THE", "the"] * 60 + ["of " + "the of " * 3_000, None, "", docs[0], docs[0]]
    monkeypatch.setattr(lm_scoring, "BUCKET_WORDS", bucket_words)
    target = [i % 3 == 0 for i in range(len(docs))]
    with monkeypatch.context() as small:
        small.setattr(lm_scoring, "SLICE_TEXTS", texts)
        small.setattr(lm_scoring, "SLICE_WORDS", words)
        batch = pd.DataFrame({"key": range(len(docs)), "text": docs, "target": target})
        cut = list(lm_scoring.Cutter().slices(iter([batch])))
        assert sum(len(s.words) for s in cut) == sum(len((d or "").split()) for d in docs)
        assert all(len(s.keys) <= texts for s in cut)
    df = spark.createDataFrame([(i, d, t) for i, (d, t) in enumerate(zip(docs, target))], "i int, text string, t boolean")
    got = {r["i"]: r for r in lm_scoring.score_by_counts(df, "t", carry=["i"]).collect()}
    for i, (n, t, b) in enumerate(plain_scores(docs, target)):
        assert got[i]["n_tokens"] == n and (got[i]["score"] is None) == (n == 0)
        assert n == 0 or (got[i]["target_loss"], got[i]["background_loss"]) == (pytest.approx(t), pytest.approx(b))


@pytest.mark.parametrize("name", ["_t", "_b", "_hash", "_n", "_row", "_text", "_key", "key", "target", "word", "bucket"])
def test_columns_of_any_name_stay(spark, name):
    df = spark.createDataFrame([("a b a", True, 5), (None, False, 6)], f"text string, is_target boolean, {name} int")
    out = lm_scoring.score_by_counts(df, "is_target")
    assert sorted(r[name] for r in out.collect()) == [5, 6] and out.columns[:3] == ["text", "is_target", name]


def test_counted_losses_of_odd_texts(spark):
    df = spark.createDataFrame([(t, i % 2 == 0, 1.0) for i, t in enumerate(ODD)], "text string, t boolean, score double")
    want = {t: w for t, w in zip(ODD, plain_scores(ODD, [i % 2 == 0 for i in range(len(ODD))]))}
    out = lm_scoring.score_by_counts(df, "t")
    assert out.columns == ["text", "t", "n_tokens", "target_loss", "background_loss", "score"]
    rows = out.collect()
    assert len(rows) == len(ODD)
    for r in rows:
        n, target, background = want[r["text"]]
        assert r["n_tokens"] == n and (r["score"] is None) == (n == 0)
        assert n == 0 or r["score"] == pytest.approx(background - target)
    assert lm_scoring.score_by_counts(df.limit(0), "t").count() == 0
    untaught = lm_scoring.score_by_counts(df.withColumn("t", F.lit(None).cast("boolean")), "t")
    assert untaught.filter("score IS NOT NULL").count() == sum(bool((t or "").split()) for t in ODD)


def test_scores_tell_good_documents_from_bad(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = labels.filter(quality_classifier.held_out(F.col("doc_id")))
    for query in (Q.op2_lm_scoring, Q.op10_quality_classifier):
        rows = query(spark, sf_dir).join(held, "doc_id").filter("score IS NOT NULL").collect()
        good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
        pairs = [(g > b) + 0.5 * (g == b) for g in good for b in bad]
        assert len(good) > 5 and len(bad) > 2 and sum(pairs) / len(pairs) > 0.95


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{x:"</p>"}</style></head><body class="has-sidebar">
<header><h1>Site</h1><a href=/>Home</a></header><nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav>
<div id="cookie-notice">We use cookies, accept them all.</div><!-- <p>no</p> -->
<div class="content"><h1>The &amp;title</h1><p>A first   paragraph of prose,\nwith <b>bold<br>words</b> in it &lt;here&gt;.</p>
<form><label>Mail</label><input><button>Go</button></form><p>Short.<p>A second paragraph, as long as the first, with <a href=x>a link</a> in it.</p>
<div class="ad">Buy now!</div><script>var p = "<p>no</p>"</script></div>
<aside>Beside the point, yet long enough to be taken for prose. And so on, and so on.</aside>
<section id="comments"><article class="comment"><p>I like this very much, and say so in a long comment.</p></article></section>
<footer>&copy; 2020 someone</footer></body></html>"""
MAIN = "The &title A first paragraph of prose, with bold words in it <here>. Short. A second paragraph, as long as the first, with a link in it."


def test_main_text_of_a_page():
    assert html_text.main_text(PAGE) == MAIN
    assert html_text.main_text(PAGE.replace('<div class="content">', "<article>").replace("</script></div>", "</script></article>")) == MAIN


PROSE = "A first paragraph of prose, with enough words in it to be taken for content by all that looks at it."


@pytest.mark.parametrize("tag", [
    '<div style="overflow: hidden">', '<article data-t="The hidden valley">', "<article data-t='x hidden id=comments'>",
    '<article title="see id=comments">', "<article data-id=comments data-hidden>", '<article alt="a" class="post" class="comments">',
    "<article x=a/hidden=1>", '<article title = "a > hidden b">',
])
def test_attributes_are_whole_names(tag):
    end = tag[1:].split(" ")[0]
    assert html_text.main_text(f"<body>{tag}<p>{PROSE}</p></{end}></body>") == PROSE


@pytest.mark.parametrize("tag", ["<article hidden>", "<article HIDDEN=''>", '<article style="x"hidden>', "<article aria-hidden = 'true'>", '<article a="b" id = comments>', "<article/class=comments>"])
def test_attributes_that_count(tag):
    assert html_text.main_text(f"<body>{tag}<p>{PROSE}</p></article></body>") == ""


@pytest.mark.parametrize("start", [
    "<html><head><title>t</title><body>", "<head><meta charset=x><style>a</style>", "<html><head><noscript><link rel=x></noscript><body>",
    "<html><head><noscript><style>a</style><body>", "<html><head></head><body><head>", "<head><template><p>no</p></template><body>", "<title>t</title>",
])
def test_omitted_end_of_the_head(start):
    assert html_text.main_text(f"<!DOCTYPE html>{start}<article><p>{PROSE}</p></article>") == PROSE
    assert html_text.main_text(f"{start}{PROSE}") == PROSE


@pytest.mark.parametrize("wrapper", ["page with-sidebar", "has-comments", "layout sidebar-left no-footer", "widget"])
@pytest.mark.parametrize("content", ["content", "x", "entry-body"])
def test_names_of_page_wrappers_tell_nothing(wrapper, content):
    page = f"""<body><div class="{wrapper}"><div class="menu"><a href=a>One</a> <a href=b>Two</a></div>
<div class="{content}"><p>{PROSE}</p><p>{PROSE}</p><p>{PROSE}</p></div>
<div class="sidebar"><p>Beside the point, yet prose.</p></div><div id="comments"><p>I like this very much.</p></div></div></body>"""
    assert html_text.main_text(page) == " ".join([PROSE] * 3)


def test_boilerplate_beside_the_content_stays_out():
    for inner in ("text", "x"):
        page = f"""<body><div class="content"><p>{PROSE}</p></div><div class="sidebar"><div class="{inner}"><p>Beside the point.</p></div></div>
<div id="comments"><div class="comment"><p>{PROSE}</p></div><div class="comment"><p>{PROSE}</p></div></div></body>"""
        assert html_text.main_text(page) == PROSE


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "<nav>x</nav>", "<!--", "<script>x", "</p></div>", "<title>x"])
def test_pages_without_text(page):
    assert html_text.main_text(page) == "" or page == "<"


@pytest.mark.parametrize("page", ["<p>a<" * 30_000, "<div>x" * 5_000, "<b" * 50_000, '<a "' * 20_000, "<ul><li>x" * 5_000, "<!--" * 20_000])
def test_broken_pages_end_soon(page):
    html_text.main_text(page)


BODIES = {
    # Short blocks between prose, in pages without any telling tag or name.
    f"<h1>Prices</h1><p>{PROSE}</p><h2>Then</h2><p>{PROSE}</p>": f"Prices {PROSE} Then {PROSE}",
    f"<div><h2>One</h2><p>{PROSE}</p><ul><li>first thing</li><li>second</li></ul><p>{PROSE}</p></div>": f"One {PROSE} first thing second {PROSE}",
    # A paragraph that is mostly a link stands in prose, and short sentences in menus.
    f"""<div><p>{PROSE}</p><p>See <a href=x>the long list of all reports there are</a></p><p>{PROSE}</p></div>
<div><div><a href=1>Item one</a></div><div><a href=2>Item two</a></div><div>Hot offers today, and only today.</div>
<div><a href=3>Item three</a></div></div>""": f"{PROSE} See the long list of all reports there are {PROSE}",
    f"""<table><tr><td><a href=1>News</a><br><a href=2>Sport</a></td><td><h1>Title here</h1><p>{PROSE}</p><p>By the way.</p><p>{PROSE}</p></td>
<td><p><a href=3>Shop now</a></p><p>Win a prize.</p><p><a href=4>Enter here</a></p></td></tr></table>""": f"Title here {PROSE} By the way. {PROSE}",
    # A name that may mean boilerplate, on a short paragraph of an article about shares.
    f'<p>{PROSE}</p><div class="share-price"><p>The share rose.</p></div><p>{PROSE}</p>': f"{PROSE} The share rose. {PROSE}",
}


@pytest.mark.parametrize("body, want", BODIES.items())
def test_the_cut_decides_where_signs_are_wrong(body, want):
    page = f"<html><body>{body}</body></html>"
    assert html_text.main_text(page) == want
    found = html_text.blocks(page)
    scores = [html_text.evidence(b, html_text.wrappers(found)) for b in found]
    alone = " ".join(b.text for b, s in zip(found, scores) if s > 0)
    assert alone != want
    labels = html_text.minimum_cut([round(html_text.SCALE * s) for s in scores], {})
    assert " ".join(b.text for b, content in zip(found, labels) if content) == alone


@pytest.mark.parametrize("name, kept", [
    ("share-price", True), ("social-policy", True), ("related-work", True), ("search-results-explained", True), ("public notice", False),
    ("share-buttons", False), ("social", False), ("related-posts", False), ("searchbox", True), ("search-box", False), ("notice2", False), ("cookie-notice", False),
])
def test_ambiguous_names(name, kept):
    page = f'<body><h1>Title</h1><p>{PROSE}</p><div class="{name}"><p>{PROSE}</p></div><p>{PROSE}</p></body>'
    assert html_text.main_text(page) == " ".join(["Title", *[PROSE] * (2 + kept)])


def test_formulas_and_drawings_are_text():
    page = f"""<article><p>The formula <math><mi>E</mi><mo>=</mo><mi>mc2</mi></math> is known.</p>
<svg><title>no</title><path d="x"/><text>a label</text></svg><p>{PROSE}</p></article>"""
    assert html_text.main_text(page) == f"The formula E=mc2 is known. a label {PROSE}"


def test_hidden_elements_count_at_any_depth():
    deep = "<div>" * 2_000
    page = f"<article><p>{PROSE}</p>{deep}<p>{PROSE}</p><div hidden><p>no</p><div>no</div></div><template><p>no</p></template><p>{PROSE}</p>"
    assert html_text.main_text(page) == " ".join([PROSE] * 3)


def test_minimum_cut_equals_the_best_of_all_labellings():
    rng = random.Random(2)
    for _ in range(400):
        n = rng.randint(1, 8)
        scores = [rng.randint(-9, 9) for _ in range(n)]
        pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(rng.randint(0, 12))]
        joined = {(i, j): rng.randint(1, 8) for i, j in pairs if i < j}

        def cost(label):
            wrong = sum(abs(s) for s, c in zip(scores, label) if c != (s > 0))
            return wrong + sum(w for (i, j), w in joined.items() if label[i] != label[j])

        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert cost(html_text.minimum_cut(scores, joined)) == best


def test_html_query_finds_the_articles(spark, sf_dir):
    import html
    import re

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in Q.op3_html(spark, sf_dir).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert (r["text"], r["n_chars"]) == (want := " ".join(p for p in parts if p), len(want))
    df = spark.createDataFrame([(PAGE, "t"), (None, "t"), (PAGE, "t")], "html string, text string")
    assert sorted(r["text"] for r in html_text.extract(df).collect()) == ["", MAIN, MAIN]
    assert html_text.extract(df.limit(0)).count() == 0


def test_classifier_of_odd_texts_and_without_labels(spark):
    df = spark.createDataFrame([(i, t, 9.0) for i, t in enumerate(ODD)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, i % 2) for i in range(len(ODD))] + [(None, 1), (3, None), (3, 7)], "doc_id long, quality int")
    out = quality_classifier.add_score(df, quality_classifier.fit(df, labels)).collect()
    assert len(out) == len(ODD) and all(0 <= r["score"] <= 1 for r in out)
    assert all(r["score"] == 0 for r in out if not (r["text"] or "").split())
    blank = quality_classifier.fit(df, labels.limit(0))
    assert {r["score"] for r in quality_classifier.add_score(df, blank).collect()} == {0.0}
    assert quality_classifier.add_score(df.limit(0), blank).count() == 0


def test_a_repeated_id_teaches_once(spark):
    docs = spark.createDataFrame([(i, f"word{i} and more") for i in range(40)] + [(1, "zzz again")] * 500, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    once = quality_classifier.fit(docs.limit(40), labels)
    repeated = quality_classifier.fit(docs, labels)
    assert len(once.labels) == len(repeated.labels) <= 40 and np.array_equal(once.vectors, repeated.vectors)


def test_labels_of_held_out_documents_teach_nothing(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    held = quality_classifier.held_out(F.col("doc_id"))
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality_classifier.fit(docs, x) for x in (labels, turned))
    assert (a.labels == b.labels).all() and np.array_equal(a.vectors, b.vectors)


def test_exact_neighbours_vote(spark):
    rng = np.random.default_rng(0)
    vectors = rng.standard_normal((80, 6)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    labels = rng.integers(0, 2, 80).astype(float)
    model = quality_classifier.Voters(np.ones(quality_classifier.CELLS, np.float32), np.zeros((quality_classifier.CELLS, 6), np.float32), vectors, labels)
    z = rng.standard_normal((5, 6)).astype(np.float32)
    object.__setattr__(model, "latent", lambda rows: z / np.linalg.norm(z, axis=1, keepdims=True))
    for got, q in zip(model.votes(np.zeros((5, 1))), z / np.linalg.norm(z, axis=1, keepdims=True)):
        cosines = vectors @ q
        near = np.argsort(-cosines)[: quality_classifier.NEIGHBOURS]
        weight = np.maximum(cosines[near], 0)
        assert got == pytest.approx((weight * labels[near]).sum() / weight.sum(), rel=1e-5)
