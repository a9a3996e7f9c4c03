"""Conversation tries, license scans and spelling variants against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from check_oracle import compare, connect, plain
from pyspark.sql import functions as F

from beforeafter.llm import licenses, prefix_trie, queries, spelling
from beforeafter.llm.oracle import ORACLE
from beforeafter.staging import stage

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
TURNS = "conv_id long, turn long, role string, text string, id string, pos int, words string, _n long"


@pytest.mark.parametrize("name", ["op11_conversation_trie", "op12_license_scan", "op13_spelling"])
def test_query_equals_sql(spark, sf_dir, name):
    con = connect(sf_dir)
    con.execute(f"CREATE VIEW answer AS {ORACLE[name]}")
    df = queries.QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert compare(plain(df.toPandas()), plain(con.execute("SELECT * FROM answer").df())) == ""


# Conversations


def sha(text):
    return hashlib.sha256(text.encode())


def nodes_by_hand(rows, shared=True):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = sha(f"{len(role.encode())}:{role}{text}").digest()
            turns[conv].append(((turn is not None, turn or 0, tie), (role, text)))
    turns = {c: [t for _, t in sorted(found)] for c, found in turns.items()}
    rebuilt = {}
    for conv, own in turns.items():
        h = zlib.crc32(str(conv).encode()) % 4 if shared else 0
        base = conv - abs(conv) % 20 * (1 if conv >= 0 else -1)
        rebuilt[conv] = turns.get(base, [])[:h] + own[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for conv, seq in rebuilt.items():
        ends[tuple(seq)].append(conv)
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(conv)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for prefix, found in members.items():
        own = (len(found) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", prefix[-1][1])) if prefix else 0
        for d in range(len(prefix) + 1):
            saved[prefix[:d]] += own
            leaves[prefix[:d]] += not children[prefix]
    return sorted(
        (
            min(found), len(p), min(members[p[:-1]]) if p else None, len(found), children[p], leaves[p], saved[p],
            sha(",".join(map(str, sorted(ends[p])))).hexdigest(),
        )
        for p, found in members.items()
    )


def nodes_of(df, segment_turns, tree_turns, shared=True):
    conv = F.col("conv_id")
    head = F.crc32(conv.cast("string")) % 4 if shared else F.lit(0)
    turns, convs = prefix_trie.grafted(prefix_trie.coded_turns(df), conv - conv % 20, head, most=3)
    found = prefix_trie.nodes(stage(turns, "grafted"), convs, segment_turns, tree_turns)
    return sorted(tuple(r[c] for c in NODE) for r in found.collect())


def made_turns():
    pick = random.Random(3)
    rows = []
    for conv in [*range(-25, 60), 10**15, 5000, 2**60 + 1]:
        for turn in range(pick.choice([0, 1, 2, 3, 5, 9])):
            rows.append((conv, pick.choice([None, turn, turn, turn]), pick.choice(["u", "a", None]), pick.choice(["x y", "", "b c d", None, "x"])))
    # Two equal long conversations, one that ends inside them, one that leaves them.
    for conv, n in ((70, 40), (71, 40), (72, 12), (73, 40)):
        rows += [(conv, t, "u", f"w{t % 3}" if conv < 73 or t < 20 else "other") for t in range(n)]
    rows += [(None, 1, "u", "without a conversation"), (74, 0, "u", "word " * 50_000)]
    return rows + rows[:20]


@pytest.mark.parametrize("segment_turns, tree_turns", [(64, 1 << 15), (64, 250), (3, 40)])
def test_trie_equals_plain_prefixes_at_every_size(spark, segment_turns, tree_turns):
    rows = made_turns()
    clash = [(*r, "id", 7, "words", 1) for r in rows]
    df = spark.createDataFrame(clash, TURNS)
    assert nodes_of(df, segment_turns, tree_turns) == nodes_by_hand(rows)


def test_trie_of_equal_conversations_and_of_none(spark):
    # All the same, over several blocks of ids: one path, all members end at its end.
    rows = [(c, t, "u", f"t{t}") for c in range(0, 9000, 3) for t in range(2)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert nodes_of(df, 64, 64, shared=False) == nodes_by_hand(rows, shared=False)
    assert nodes_of(df.limit(0), 64, 64) == []


def test_search_tree_balances_and_counts():
    assert sorted(prefix_trie._medians(7)) == list(range(7))
    assert list(prefix_trie._medians(7))[0] == 3
    tree = prefix_trie.SearchTree()
    paths = [tree.insert([0, i], [0, 1]) for i in map(int, prefix_trie._medians(1023))]
    deepest = 0
    for path in paths:
        at, steps = tree.below[path[0]], 0
        while at != path[1]:
            at = (tree.less if tree.symbol[path[1]] < tree.symbol[at] else tree.more)[at]
            steps += 1
        deepest = max(deepest, steps)
    assert deepest == 9


# Licenses

PHRASES = {
    ("gnu", "general", "public", "license"): "gpl", ("apache", "license"): "apache", ("cc", "by"): "cc-by", ("mit", "license"): "mit",
}
NOTICE = " ".join(t.text for t in licenses.NOTICES if t.label == "bsd")
TEXTS = [
    None, "", " \n ", "no license here", "GNU General-Public\nLICENSE!", "gnu general public licenses", "agnu general public license",
    "cc cc by by cc by", "mit license apache license mit license", "Émit license", "mit license", "mit licenseé",
    "licensed under cc by-nc 4.0", NOTICE, NOTICE.replace("binary", "any"), "#  " + NOTICE.upper().replace(" ", "\n * "),
    "x " * 30_000 + "mit license " * 5_000 + "end", "a apache license", "a apache license",
]


def base_by_hand(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    at = [(i, label) for i in range(len(words)) for phrase, label in PHRASES.items() if tuple(words[i : i + len(phrase)]) == phrase]
    starts = [i for i, _ in at]
    return len(words), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))


def test_license_scan_equals_plain_search(spark):
    schema = "doc_id long, text string, labels string, _places long, n_words string, _starts0 int"
    rows = [(i, t, "l", 2, "n", 3) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, schema)
    found = licenses.scan(df, carry=["doc_id", "_places", "_starts0", "labels"])
    assert found.columns[:3] == ["doc_id", "_places", "_starts0"] and found.columns.count("labels") == 1
    got = {r["doc_id"]: r for r in found.collect()}
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == base_by_hand(text), text
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
        assert (r["score"] > 0) == bool(r["labels"])
    assert "cc-by-nc-4.0" in got[12]["labels"] and got[13]["labels"] == got[15]["labels"] == "bsd"
    # A notice whose mandatory phrase is changed is none, however much else agrees.
    assert got[14]["labels"] == "" and got[14]["score"] == 0 and got[13]["score"] == 1
    assert licenses.scan(df.limit(0)).count() == 0
    assert licenses.scan(df.drop("text").withColumn("body", F.lit("cc by")), text_col="body", carry=[]).first()["n_base"] == 1


def test_license_phrases_have_to_lie_in_their_template():
    with pytest.raises(ValueError):
        licenses.postings(licenses.Template("x", "some words", ("other words",)))


# Spelling


def forms_by_hand(counts, ratio=5):
    near, form = defaultdict(set), {}

    def one_edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        if len(a) > len(b):
            a, b = b, a
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    words = sorted(counts)
    for i, a in enumerate(words):
        for b in words[i + 1 :]:
            if abs(len(a) - len(b)) < 2 and one_edit(a, b):
                near[a].add(b)
                near[b].add(a)
    for w in words:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return out


def made_words():
    pick = random.Random(11)
    stems = ["".join(pick.choice("abcdeé") for _ in range(pick.randint(1, 9))) for _ in range(60)]
    counts = {}
    for stem in stems:
        counts[stem] = pick.randint(1, 4000)
        for _ in range(12):
            i, letter = pick.randrange(len(stem)), pick.choice("abcdeéxX𝕏")
            w = pick.choice([stem[:i] + stem[i + 1 :], stem[:i] + letter + stem[i:], stem[:i] + letter + stem[i + 1 :]])
            counts.setdefault(w, pick.choice([1, 1, 2, 5, 40, 200]))
    # A chain of three forms, a tie, words of the same letters, long ones.
    counts |= {"chainaa": 1, "chainab": 5, "chainbb": 25, "chainbc": 3125, "tiedxx": 2, "tiedxa": 20, "tiedxb": 20, "stop": 9, "pots": 90}
    counts |= {"l" * 5000: 1, "l" * 5001: 6}
    return counts


def test_spelling_forms_equal_all_pairs(spark, rows):
    counts = made_words()
    listed = [(w, n - 1, 3) for w, n in counts.items() if n > 1] + [(w, 1, 3) for w in counts] + [(None, 7, 3)]
    got = spelling.forms(spark.createDataFrame(listed, "word string, n long, key long"))
    assert rows(got) == sorted(forms_by_hand(counts), key=repr)
    assert spelling.forms(spark.createDataFrame([], "word string, n long")).count() == 0


def test_spelling_signatures_cover_every_edit():
    for distance, first, second in ((1, 1, 2), (2, 1, 4), (2, 2, 3), (2, 3, 1), (3, 2, 4)):
        kept = spelling.enumerated(distance, first, second)
        parts = range(first * second)
        for changed in {frozenset(random.Random(i).choices(parts, k=distance)) for i in range(200)}:
            assert any(not changed & set(k) for k in kept)
    with pytest.raises(ValueError):
        spelling.enumerated(2, 1, 2)
    dims: dict = {}
    word = "abcabcd"
    for i in range(len(word)):
        for other in (word[:i] + word[i + 1 :], word[:i] + "z" + word[i + 1 :], word[:i] + "a" + word[i:]):
            assert other == word or set(spelling.signatures(word, dims)) & set(spelling.signatures(other, dims))


def test_spelling_query_counts_slipped_words(spark, tmp_path):
    texts = {1: None, 2: "", None: "éèêëàâ " * 5, 3: "Lettres×÷ LETTRES lettres\nlettres,lettres letTres short", 4: "abcdef-ghijkl " * 300, 5: "Z" * 40_000 + " zz"}
    texts |= {i: "wordyword " * 2 for i in range(100, 700)}
    df = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, word string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    counts = Counter()
    for i, text in texts.items():
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 5}
    got = sorted(tuple(r) for r in queries.op13_spelling(spark, str(tmp_path)).collect())
    assert len(counts) > 4 and got == sorted(forms_by_hand(counts))
