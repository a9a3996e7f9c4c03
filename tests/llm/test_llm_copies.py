"""SimHash, vector near duplicates and components against brute force."""

import random

import numpy as np
import pytest
import xxhash

from beforeafter.llm import components, simhash, vector_dedup

SCHEMA = "doc_id long, text string, row string, fp string, uid string, id string, kept string"


def plain_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots_of(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(300)] + [(1000, 1000 + k) for k in range(200)] + [(5, 5), (7, 6)]
    pairs += [(rng.randrange(2000, 2600), rng.randrange(2000, 2600)) for _ in range(350)]
    rng.shuffle(pairs)
    got = {r["node"]: r["root"] for r in components.connected(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = roots_of({x for p in pairs for x in p}, pairs)
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {n: want[n] for n in linked}
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprints_equal_a_plain_count():
    rng = random.Random(1)
    texts = [None, "", " \t\n", "One", "One two", "ONE two\x0bthree", "a b c d", "É é À", "a  b\x0cc\rd", "x\x1cy z w", "w " * 70_000]
    texts += [" ".join(rng.choice("abcdeÄß") * rng.randint(1, 3) for _ in range(rng.randint(1, 60))) for _ in range(40)]
    assert [simhash.fingerprint(t) % (1 << 64) for t in texts] == [plain_fingerprint(t) for t in texts]
    assert simhash.fingerprint("") == 0


@pytest.mark.parametrize("distance", [1, 2, 3, 4])
def test_links_connect_what_all_pairs_connect(spark, distance):
    if distance == 4:
        pytest.skip("balls of radius 2 on both sides: the same law as for 2, at 30 times the rows")
    rng = random.Random(distance)
    fps = [rng.getrandbits(64) for _ in range(30)] + [0, (1 << 64) - 1]
    for base in fps[:20]:
        for _ in range(6):
            near = base
            for b in rng.sample(range(64), rng.randint(1, distance + 2)):
                near ^= 1 << b
            fps.append(near)
    crowd = rng.getrandbits(64)  # many within a few bits of one
    fps += [crowd ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(150)]
    fps = sorted({simhash._signed(f) for f in fps})
    links = simhash.linked(spark.createDataFrame([(f,) for f in fps], "fp long"), distance)
    got = [(r["a"], r["b"]) for r in links.collect()]
    apart = lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count()
    assert all(apart(a, b) <= distance for a, b in got)
    pairs = [(a, b) for i, a in enumerate(fps) for b in fps[:i] if apart(a, b) <= distance]
    assert roots_of(fps, got) == roots_of(fps, pairs)


def odd_docs(spark):
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(9, base), (4, base), (4, base), (11, base + " end"), (None, "lonely text here now"), (2, None), (1, ""), (3, " "), (8, "w " * 90_000), (None, "another lonely one"), (None, "another lonely one")]
    return spark.createDataFrame([(i, t, "r", "f", "u", "x", "k") for i, t in rows], SCHEMA), rows


def test_simhash_classes_of_odd_rows(spark):
    df, rows = odd_docs(spark)
    got = simhash.classes(df, carry=["doc_id", "text"]).collect()
    fps = [plain_fingerprint(t) for _, t in rows]
    signed = sorted({simhash._signed(f) for f in fps})
    apart = lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count()
    root = roots_of(signed, [(a, b) for i, a in enumerate(signed) for b in signed[:i] if apart(a, b) <= 3])
    ids = {}
    for (i, _), f in zip(rows, fps):
        ids.setdefault(root[simhash._signed(f)], []).append(i)
    want = {r: min((i for i in group if i is not None), default=None) for r, group in ids.items()}
    expected = sorted(((i, t, f"{f:016x}", want[root[simhash._signed(f)]]) for (i, t), f in zip(rows, fps)), key=repr)
    assert sorted(((r["doc_id"], r["text"], r["fingerprint"], r["component_id"]) for r in got), key=repr) == expected
    assert sum(r["kept"] for r in got) == len(ids)
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns and kept.count() == len(ids)
    assert {r["row"] for r in kept.collect()} == {"r"}
    assert simhash.one_of_each(df.limit(0)).count() == 0 and simhash.classes(df.limit(0)).count() == 0


def plain_vectors(rows, least):
    ok = [i for i, (_, v, label) in enumerate(rows) if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    pairs = []
    for n, i in enumerate(ok):
        for j in ok[:n]:
            a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
            if rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= least:
                pairs.append((i, j))
    root = roots_of(range(len(rows)), pairs)
    links = [0] * len(rows)
    for i, j in pairs:
        links[i] += 1
        links[j] += 1
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        component = min(ids, default=None)
        out.append((vec_id, links[i], component, vec_id == component))
    return sorted(out, key=repr)


@pytest.mark.parametrize("cell_rows, block_rows", [(4_096, 2_048), (40, 25), (15, 7)])
def test_vectors_equal_brute_force_however_they_are_cut(spark, monkeypatch, cell_rows, block_rows):
    monkeypatch.setattr(vector_dedup, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(vector_dedup, "BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(8)
    rows = [(int(i), [float(x) for x in rng.standard_normal(4).astype(np.float32)], int(rng.integers(0, 3))) for i in range(260)]
    centre = rng.standard_normal(4)
    rows += [(int(1000 + i), [float(x) for x in (centre + 0.1 * rng.standard_normal(4)).astype(np.float32)], 1) for i in range(60)]
    rows += [(2000 + i, rows[3][1], rows[3][2]) for i in range(5)] + [(2100, [2 * x for x in rows[3][1]], rows[3][2])]
    nan, inf = float("nan"), float("inf")
    for i, v in enumerate([None, [], [0.0] * 4, [1.0, None, 0.0, 0.0], [nan, 1.0, 0.0, 0.0], [inf, 1.0, 0.0, 0.0], [1.0, 1.0], [1.0, 1.0]]):
        rows.append((3000 + i, v, 1))
    rows += [(4000, rows[3][1], None), (4001, rows[3][1], None), (None, rows[3][1], rows[3][2]), (rows[3][0], rows[3][1], rows[3][2])]
    df = spark.createDataFrame([(i, v, label, 1) for i, v, label in rows], "vec_id long, embedding array<float>, label int, uid int")
    got = vector_dedup.classes_of(df)
    # One id twice: brute force goes by place, so compare what both can say.
    assert sorted(map(tuple, got.collect()), key=repr) == plain_vectors(rows, 0.93)
    assert vector_dedup.classes_of(df.limit(0)).count() == 0
