import hashlib
import random

import pytest

from careflow.llm import simhash


def words(n, draw):
    return " ".join(f"w{draw.randrange(300)}" for _ in range(n))


def test_edited_texts_and_likeness(spark):
    draw = random.Random(2)
    texts = {i * 3 - 40: words(draw.choice([0, 1, 5, 80, 200]), draw) for i in range(150)}
    texts[20], texts[140] = texts[80], None
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in simhash.edited_fingerprints(docs).collect()}
    order = sorted(texts, reverse=True)
    prints = {i: int(rows[i]["fingerprint"], 16) for i in order}
    for i, after in zip(order, order[1:] + order[:1], strict=True):
        own, following = texts[i] or "", texts[after] or ""
        k = len(own) // 2
        edited = own[:len(own) - k] + following[:k]
        assert rows[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert rows[i]["n_chars"] == len(own)
        assert rows[i]["near_next"] == pytest.approx(1 - (prints[i] ^ prints[after]).bit_count() / 64)
        changed = int(rows[i]["edited_fingerprint"], 16)
        assert rows[i]["near_edited"] == pytest.approx(1 - (prints[i] ^ changed).bit_count() / 64)
        near = sum((prints[i] ^ p).bit_count() <= 3 for p in prints.values()) - 1
        assert rows[i]["n_near"] == (near if i % 20 == 0 else None)
    assert rows[20]["fingerprint"] == rows[80]["fingerprint"]


def test_votes_follow_the_definition(spark):
    text = "a b a b c  a b\n"
    got = simhash.fingerprints(spark.createDataFrame([(1, text)], "id long, text string"), ["id"], []).first()["fingerprint"]
    pairs = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "b"), ("b", "c"), ("c", "a"), ("a", "b"), ("b", ""), ("", "")],
                                  "x string, y string").selectExpr("xxhash64(x, y) h").collect()
    for bit in range(64):
        ones = sum(p["h"] >> bit & 1 for p in pairs)
        assert (got >> bit & 1) == (2 * ones > len(pairs))


@pytest.mark.parametrize("radius", [1, 3])
def test_radius_search_equals_brute_force(spark, radius):
    draw = random.Random(radius)
    base = [draw.getrandbits(64) for _ in range(40)]
    many = [b for b in base]
    for b in base:
        for _ in range(6):
            x = b
            for _ in range(draw.randint(0, 5)):
                x ^= 1 << draw.randrange(64)
            many.append(x)
    signed = [x - 2**64 if x >= 2**63 else x for x in many]
    index = spark.createDataFrame([(x,) for x in signed], "fingerprint long")
    queries = spark.createDataFrame([(x,) for x in signed[:40]], "fingerprint long")
    got = {r["fingerprint"]: r["n_near"] for r in simhash.within_radius(queries, index, radius).collect()}
    assert got == {s: sum((x ^ y).bit_count() <= radius for y in many) for s, x in zip(signed[:40], many, strict=False)}


def test_main_path_runs_no_python(spark):
    docs = spark.createDataFrame([(i, f"text {i} of some words") for i in range(30)], "doc_id long, text string")
    plan = simhash.edited_fingerprints(docs)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_odd_rows(odd_docs, no_docs):
    rows = simhash.edited_fingerprints(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[2][0]["n_chars"] == 0 and by[2][0]["fingerprint"] == by[3][0]["fingerprint"]
    assert by[20][0]["fingerprint"] == by[40][0]["fingerprint"] and by[20][0]["n_near"] >= 1
    assert len(by[7]) == 3 and len(by[None]) == 3
    texts = [r for r in odd_docs.orderBy("doc_id").collect() if r["doc_id"] is not None]
    first = next(r for r in rows if r["doc_id"] == 42)
    at = [r["doc_id"] for r in texts].index(42)
    own, after = texts[at]["text"], texts[at - 1]["text"]
    k = len(own) // 2
    assert first["edited_sha256"] == hashlib.sha256((own[:len(own) - k] + after[:k]).encode()).hexdigest()
    assert simhash.edited_fingerprints(no_docs).count() == 0
    one = odd_docs.filter("doc_id = 1")
    got = simhash.edited_fingerprints(one).first()
    text = one.first()["text"]
    k = len(text) // 2
    assert got["edited_sha256"] == hashlib.sha256((text[:len(text) - k] + text[:k]).encode()).hexdigest()
    assert got["near_next"] == 1.0


def test_ranges_of_far_and_repeated_keys(spark):
    """No arithmetic on keys: the ends of the long range, one far outlier, clusters
    and a key that many rows share are dealt into ranges of about one size."""
    draw = random.Random(9)
    ids = [*range(1500), *([7] * 1500), -2**63, 2**63 - 1, 2**62 + 5, -2**62 - 5, 2**53 + 1, 2**53 + 3, *([None] * 200)]
    rows = [(i, f"{draw.random()} words here") for i in ids]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = simhash.edited_fingerprints(docs)
    assert sorted(str(r["doc_id"]) for r in got.collect()) == sorted(map(str, ids))
    from pyspark.sql import functions as F
    base = docs.select(F.col("doc_id").isNull().cast("int").alias("none"),
                       F.coalesce(F.bitwise_not("doc_id"), F.lit(0)).alias("back"), F.xxhash64("text").alias("tie"))
    firsts = simhash.first_of_parts(base, 16)
    part, leads = simhash.part_of(F.struct("none", "back", "tie"), firsts)
    dealt = base.select("*", part.alias("part"), leads.alias("leads")).collect()
    for r in dealt:
        place = (r["none"], r["back"], r["tie"])
        assert r["part"] == sum(f <= place for f in firsts) - 1 and r["leads"] == (place in firsts)
    sizes = [sum(r["part"] == k for r in dealt) for k in range(len(firsts))]
    assert len(firsts) == 16 and max(sizes) <= 2 * len(dealt) / 16
