import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from careflow.llm import components, embedding_dedup, minhash_dedup

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def shingles(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def closure(ids, links):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def brute(texts, percent=85):
    """Components by the definition, every pair compared."""
    sets = {i: shingles(t) for i, t in texts.items()}
    links = [(a, b) for a, b in combinations(sets, 2)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return closure(texts, links), sets


def corpus(seed):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts, at = {}, 100
    for size, n in ((60, 8), (120, 30), (200, 12), (9, 10)):
        base = [draw.choice(vocabulary) for _ in range(size)]
        for _ in range(n):
            words = list(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 3, 6])):
                words[draw.randrange(size)] = draw.choice(vocabulary)
            texts[at] = " ".join(words)
            at += draw.randint(1, 5)
    for _ in range(30):
        texts[at] = " ".join(draw.choice(vocabulary) for _ in range(draw.randint(1, 80)))
        at += 1
    return texts


def test_sets_are_those_of_the_definition():
    texts = ["", " ", "one", "One  TWO\tthree\nfour", "a b c d e", "A b c d e f", "a b c d e a b c d e a b c d e",
             "É é è\x0bx\x0cy z", "a b c d e f", "w" * 999 + " b c d e " + "w" * 998 + " b c d e"]
    sets = minhash_dedup.shingle_sets(texts)
    want = [shingles(t) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in want]
    for (a, x), (b, y) in combinations(list(zip(sets, want, strict=True)), 2):
        assert len(np.intersect1d(a, b)) == len(x & y)
    for text, s in zip(texts, sets, strict=True):  # neighbours in a batch make no difference
        assert np.array_equal(minhash_dedup.shingle_sets([text])[0], s)


def test_estimate_is_close_to_the_similarity():
    draw = np.random.default_rng(5)
    for share in (0.0, 0.3, 0.7, 0.95):
        errors = []
        for _ in range(20):
            both = draw.integers(0, 2**63, int(400 * share), dtype=np.uint64)
            a, b = (np.concatenate([both, draw.integers(0, 2**63, 400 - len(both), dtype=np.uint64)]) for _ in range(2))
            x, y = minhash_dedup.sketches([a, b])
            true = len(both) / (800 - len(both))
            errors.append(minhash_dedup.estimate(x, y[None, :])[0] - true)
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.06


@pytest.mark.parametrize("block", [4, 64])
def test_components_equal_brute_force(spark, monkeypatch, block):
    """With a small block, groups take the path of large ones."""
    monkeypatch.setattr(minhash_dedup, "BLOCK", block)
    monkeypatch.setattr(minhash_dedup, "SET_BLOCK", max(2, block // 8))
    texts = corpus(block)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want, sets = brute(texts)
    rows = minhash_dedup.near_duplicates(docs).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == want
    assert {r["doc_id"]: r["n_shingles"] for r in rows} == {i: len(s) for i, s in sets.items()}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_a_chain_and_a_group_of_copies(spark):
    """Links that only a chain connects, and copies of one text, are one component each."""
    base = [f"c{i}" for i in range(300)]
    texts = {}
    for k in range(8):  # each differs from the one before in one word
        texts[1000 - k] = " ".join(base[:k * 20] + [f"x{i}" for i in range(k)] + base[k * 20 + k:])
    for k in range(200):
        texts[k] = "the same text again and again in every one of the copies"
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in minhash_dedup.near_duplicates(docs).collect()}
    assert got == brute(texts)[0]


@pytest.mark.parametrize("percent", [80, 85])
def test_rows_that_repeat_a_key(spark, percent):
    """Components follow texts, not keys: keys repeat with other texts, texts with
    other keys, rows altogether; keys near 2**62 stay exact beside null ones."""
    texts = list(corpus(percent).values())
    draw = random.Random(percent)
    keys = [*range(40), 2**53 + 1, 2**53 + 3, -2**62 - 5, 2**62 + 5]
    rows = [(draw.choice(keys), draw.choice(texts)) for _ in range(120)]
    rows += rows[:9] + [(5, "a b c d e f g h"), (5, "p q r s t u v w"), (1, "a b c d e f g h i"), (None, texts[0]), (None, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    distinct = sorted({t for k, t in rows if k is not None})
    group, _ = brute(dict(enumerate(distinct)), percent)
    least = {}
    for k, t in rows:
        if k is not None:
            g = group[distinct.index(t)]
            least[g] = min(least.get(g, k), k)
    got = sorted((str(r["doc_id"]), r["tag"], str(r["component_id"])) for r in
                 minhash_dedup.near_duplicates(docs.withColumn("tag", F.col("text")), percent, carry=("tag",)).collect())
    want = sorted((str(k), t, str(None if k is None else least[group[distinct.index(t)]])) for k, t in rows)
    assert got == want
    firsts = minhash_dedup.near_duplicates(docs, percent).filter("first and doc_id is not null").collect()
    assert {r["doc_id"] for r in firsts} == set(least.values())


def test_bands_of_a_similarity():
    assert minhash_dedup.band_shape(85) == (30, 7) and minhash_dedup.band_shape(80) == (35, 6)
    for percent in range(50, 100):
        bands, rows = minhash_dedup.band_shape(percent)
        assert bands * rows <= minhash_dedup.REGISTERS and (1 - (percent / 100) ** rows) ** bands <= 1e-4


def test_vectors_that_repeat_a_key(spark):
    """Links stay within a label, and components follow vectors, not keys."""
    draw = np.random.default_rng(4)
    base = draw.standard_normal((12, 16))
    rows = []
    for i in range(150):
        v = base[draw.integers(12)] + 0.12 * draw.standard_normal(16)
        key = int(draw.choice([*range(50), 2**53 + 1, 2**53 + 3, 2**62 + 5]))
        rows.append((None if i % 29 == 0 else key, str(draw.choice(["x", "y"])), [float(c) for c in v]))
    rows += rows[:12] + [(k, "z", v) for k, _, v in rows[:12]]
    table = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>").repartition(4)
    units = [np.array(v) / np.linalg.norm(v) for _, _, v in rows]
    links = [(a, b) for a, b in combinations(range(len(rows)), 2)
             if rows[a][0] is not None and rows[b][0] is not None and rows[a][1] == rows[b][1] and units[a] @ units[b] >= 0.93]
    group = closure(range(len(rows)), links)
    least, n = {}, [0] * len(rows)
    for i, (k, _, _) in enumerate(rows):
        if k is not None:
            least[group[i]] = min(least.get(group[i], k), k)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    want = sorted((str(k), n[i], str(None if k is None else least[group[i]])) for i, (k, _, _) in enumerate(rows))
    got = sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]))
                 for r in embedding_dedup.near_duplicate_vectors(table).collect())
    assert got == want and sum(n) > 100


def test_documents_of_odd_rows(odd_docs, no_docs):
    rows = minhash_dedup.near_duplicates(odd_docs, carry=("lang",)).collect()
    assert len(rows) == odd_docs.count() and "lang" in rows[0].asDict()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"], r["kept"]))
    assert by[2] == [(0, 2, True)] and by[3] == [(0, 3, True)] and by[4] == [(0, 4, True)]
    assert by[6] == [(by[1][0][0], 1, False)]
    assert by[40] == [(by[20][0][0], 20, False)]
    assert {x[1] for x in by[7]} == {7} and len(by[7]) == 3
    assert all(x[1] is None and x[2] for x in by[None])
    assert minhash_dedup.near_duplicates(no_docs).count() == 0


def test_connected_components_of_long_and_wide_graphs(spark):
    draw = random.Random(1)
    order = list(range(60))
    draw.shuffle(order)
    links = [(order[i], order[i + 1]) for i in range(40)]  # a path in shuffled order
    links += [(500, i) for i in range(501, 560)] + [(1000, 1001), (1001, 1000), (1002, 1001), (7000, 7000)]
    frame = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.connected_components(frame).collect()}
    nodes = {x for link in links for x in link}
    assert got == closure(nodes, links)
    assert components.connected_components(frame.filter("a < -5")).count() == 0


def brute_vectors(rows, cosine):
    sound = {}
    for i, v, label in rows:
        x = None if v is None or any(c is None for c in v) else np.asarray(v, np.float32).astype(float)
        if x is not None and label is not None and len(x) and np.isfinite(x).all() and x.any():
            sound[i] = (x / np.linalg.norm(x), label)
    links = [(a, b) for a, b in combinations(sound, 2) if sound[a][1] == sound[b][1]
             and len(sound[a][0]) == len(sound[b][0]) and sound[a][0] @ sound[b][0] >= cosine]
    n = dict.fromkeys((r[0] for r in rows), 0)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    return n, closure(n, links)


@pytest.mark.parametrize("part", [8, 4096])
def test_vectors_equal_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(embedding_dedup, "PART", part)
    draw = np.random.default_rng(part)
    rows, at = [], 50
    for label in (0, 1):
        for size in (1, 3, 40):
            centre = draw.standard_normal(16)
            for _ in range(size):
                v = centre + draw.standard_normal(16) * draw.choice([0, 0.15, 0.3, 0.6])
                rows.append((at, [float(np.float32(c)) for c in v * draw.choice([1, 3])], label))
                at += 1
        rows += [(at + k, [float(c) for c in draw.standard_normal(16)], label) for k in range(30)]
        at += 30
    same = [1.0, 2.0, 3.0, 4.0, 5.0]
    rows += [(1, same, 0), (2, same, 0), (3, same, 1), (4, same, None), (5, [0.0] * 16, 0), (6, None, 0), (7, [], 0),
             (8, [float("nan")] + [1.0] * 15, 0), (9, [float("inf")] + [1.0] * 15, 0), (10, [2.0], 1), (11, [5.0], 1),
             (12, [-5.0], 1), (13, [None, 1.0], 1), (14, [3e38, 3e38, 0.0], 1), (15, [1e-30, 1e-30, 0.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    frame = frame.selectExpr("*", "'clash' as rep", "'clash' as block", "'clash' as unit")
    got = embedding_dedup.near_duplicate_vectors(frame).collect()
    n, component = brute_vectors(rows, 0.93)
    assert {r["vec_id"]: r["n_links"] for r in got} == n
    assert {r["vec_id"]: r["component_id"] for r in got} == component
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got) and len(got) == len(rows)


def test_vectors_of_odd_tables(spark):
    kind = "vec_id long, embedding array<float>, label int"
    assert embedding_dedup.near_duplicate_vectors(spark.createDataFrame([], kind)).count() == 0
    rows = [(None, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1)]
    got = embedding_dedup.near_duplicate_vectors(spark.createDataFrame(rows, kind)).collect()
    assert sorted((r["vec_id"] or -1, r["n_links"], r["component_id"] or -1, r["kept"]) for r in got) == [
        (-1, 0, -1, True), (-1, 0, -1, True), (3, 1, 3, True), (3, 1, 3, True)]
