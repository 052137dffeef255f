import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from careflow.llm import language_id, quality, queries
from tests.llm.conftest import SF_CHECK


def test_held_out_rule(spark):
    ids = [*range(50), -3, 10**15]
    got = {r[0]: (r[1], r[2]) for r in spark.createDataFrame([(i,) for i in ids], "doc_id long").select(
        "doc_id", quality.held_out("doc_id", 4, 2), quality.held_out("doc_id", 5, 0)).collect()}
    assert got == {i: (zlib.crc32(str(i).encode()) % 4 == 2, zlib.crc32(str(i).encode()) % 5 == 0) for i in ids}


def test_language_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "lang")
    rows = queries.op1_language_id(spark, SF_CHECK).join(docs, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == 1000 and 150 < len(held) < 350
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["rejected"] for r in rows]) < 0.01


def test_smoothing_gives_probabilities():
    """In every context the probabilities of all known characters and an unknown one add up to at most 1,
    and to nearly 1 where the context is known."""
    texts = ["the cat sat on the mat and the dog sat on the log", "that thin thing there"]
    orders, unseen = language_id.fit_orders([texts])
    alphabet = sorted({c for t in texts for c in t})
    for context in ("th", "e c", "zz", "", "sat"):
        lines = [context + c for c in alphabet]
        points = [np.frombuffer((" " + s).encode("utf-32-le"), np.uint32) for s in lines]
        first = np.concatenate([[0], np.cumsum([len(p) for p in points])])
        log_p = language_id._log_probabilities(np.concatenate(points), first, orders, unseen)
        assert 0.9 < np.exp(log_p[first[1:] - 1, 0]).sum() < 1.0 + 1e-5


def test_foreign_text_is_rejected_and_order_of_texts_does_not_matter():
    english = ["the ship and the sea were calm that day, and nothing in the harbour moved " * 3] * 12
    german = ["das schiff und die see waren an diesem tag ruhig und nichts im hafen bewegte sich " * 3] * 12
    models = language_id.fit(english + german, ["en"] * 12 + ["de"] * 12)
    texts = ["the sea was calm", "die see war ruhig", "Совершенно другой текст на другом языке"]
    entropy, n, _ = language_id.cross_entropies(texts, models.orders, models.log_unseen)
    assert [models.languages[k] for k in entropy.argmin(axis=1)[:2]] == ["en", "de"]
    limit = models.ceiling[0] + models.ceiling[1] / np.sqrt(n)
    assert (entropy.min(axis=1) > limit).tolist() == [False, False, True]
    again, _, _ = language_id.cross_entropies(texts[::-1], models.orders, models.log_unseen)
    assert np.allclose(again[::-1], entropy)


@pytest.mark.parametrize("unlearned", ["en", "de", "es", "fr"])
def test_a_language_left_out_of_training_is_rejected(spark, unlearned):
    """All four are written in one script; the other three stay."""
    rows = sorted(spark.read.parquet(f"{SF_CHECK}/documents.parquet").filter("length(text) >= 200")
                  .select("doc_id", "lang", "text").collect(), key=lambda r: r["doc_id"])
    held = lambda r: zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2
    train = [r for r in rows if r["lang"] != unlearned and not held(r)]
    models = language_id.fit([r["text"][:3000] for r in train], [r["lang"] for r in train])
    probe = [r for r in rows if held(r)]
    entropy, n, _ = language_id.cross_entropies([r["text"] for r in probe], models.orders, models.log_unseen)
    rejected = entropy.min(axis=1) > models.limit(entropy.argmin(axis=1), n)
    foreign = np.array([r["lang"] == unlearned for r in probe])
    assert rejected[foreign].mean() > 0.85 and rejected[~foreign].mean() < 0.02


def test_ceiling_is_the_quantile_of_every_length():
    draw = np.random.default_rng(3)
    n = np.repeat([9, 16, 31, 61, 121, 401, 3001], 4000)
    own = 1.5 + draw.normal(0, 1, len(n)) / np.sqrt(n)
    a, b = language_id._ceiling(own, n)
    for size in np.unique(n):
        above = (own > a + b / np.sqrt(size))[n == size].mean()
        assert above <= 0.0015
    assert a < 1.5 + 4 / np.sqrt(401) and language_id._ceiling(own[:5], n[:5]) is None


def test_languages_of_odd_rows(odd_docs, no_docs):
    models = language_id.fit_on_table(odd_docs, F.lit(True))
    rows = language_id.identify(odd_docs, models).collect()
    assert len(rows) == odd_docs.count()
    by = {r["doc_id"]: r for r in rows}
    for i in (2, 3, 4, 5):  # null, empty, blanks, no letter
        assert (by[i]["lang_pred"], by[i]["score"], by[i]["rejected"], by[i]["cross_entropy"]) == ("und", 0.0, True, None)
    assert by[1]["lang_pred"] == "en" and by[7]["lang_pred"] in ("en", "de")
    assert language_id.fit_on_table(no_docs, F.lit(True)) is None
    assert {r["lang_pred"] for r in language_id.identify(odd_docs, None).collect()} == {"und"}
    assert language_id.identify(no_docs, models).count() == 0


def test_quality_accuracy_on_held_out_documents(spark):
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    rows = queries.op10_quality(spark, SF_CHECK).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 50
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.93
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_quality_without_both_classes_gives_the_prior():
    assert quality.fit(["a", "b"], [1, 1]).prior == 1.0
    assert quality.fit([], []).prior == 0.5


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    good = [f"the {a} of the {b} was calm and clear in the morning" for a in ("sea", "sky", "day") for b in ("ship", "town")]
    bad = [f"$$$ {a}!! BUY!! {a}!! ### NOW!! $$$ {a}!!" for a in ("THIS", "THAT", "ALL", "FREE", "CHEAP")]
    model = quality.fit(good + bad, [1] * len(good) + [0] * len(bad))
    rows = quality.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    by = {r["doc_id"]: r["score"] for r in rows}
    assert by[2] == by[3] == pytest.approx(len(good) / (len(good) + len(bad)))
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert quality.score(no_docs, model).count() == 0
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (7, 5, 0), (None, 1, 0), (41, None, 0)],
                                   "doc_id long, quality int, toxic int")
    assert quality.fit_on_tables(odd_docs, labels, F.lit(True)).dictionaries is None


def plain_kneser_ney(texts_by_language, wanted):
    """Cross-entropies by dictionaries of strings, one language at a time."""
    from collections import Counter, defaultdict
    folded = lambda t: "".join(map(chr, language_id.fold([t])[0]))
    corpora = [[folded(t) for t in texts] for texts in texts_by_language]
    size = len({c for corpus in corpora for t in corpus for c in t}) + 1
    d, top = language_id.DISCOUNT, language_id.ORDER
    out = []
    for corpus in corpora:
        raw = {n: Counter(t[i:i + n] for t in corpus for i in range(len(t) - n + 1)) for n in range(1, top + 1)}
        counts = {top: dict(raw[top])}
        for n in range(1, top):     # different characters before; those that only begin texts have none
            before = defaultdict(set)
            for g in raw[n + 1]:
                before[g[1:]].add(g[0])
            counts[n] = {g: max(len(before[g]), 1e-9) for g in raw[n]}
        totals, kinds = defaultdict(float), Counter()
        for n in range(1, top + 1):
            for g, c in counts[n].items():
                totals[n, g[:-1]] += c
                kinds[n, g[:-1]] += 1

        def p(gram):
            n, context = len(gram), gram[:-1]
            if n == 1:
                spare = min(1.0, d * kinds[1, ""] / max(totals[1, ""], 1.0)) or 1.0
                return spare / size + max(counts[1].get(gram, 0) - d, 0) / max(totals[1, ""], 1.0)
            if (n, context) not in kinds:
                return p(gram[1:])
            left = min(1.0, d * kinds[n, context] / totals[n, context])
            return max(counts[n].get(gram, 0) - d, 0) / totals[n, context] + left * p(gram[1:])

        out.append([])
        for text in map(folded, wanted):
            grams = [text[max(0, i - top + 1):i + 1] for i in range(1, len(text))]
            out[-1].append(-sum(np.log(p(g)) for g in grams) / max(1, len(grams)))
    return np.array(out).T


def test_cross_entropies_against_dictionaries(spark):
    rows = spark.read.parquet(f"{SF_CHECK}/documents.parquet").filter("length(text) between 50 and 600").orderBy("doc_id").collect()
    languages = ["de", "en", "es", "fr"]
    train = [[r["text"] for r in rows if r["lang"] == lang][:12] for lang in languages]
    wanted = [r["text"] for r in rows[-25:]] + ["Совершенно другой текст", "a", "the QUICK brown — fox"]
    orders, unseen = language_id.fit_orders(train)
    got, _, _ = language_id.cross_entropies(wanted, orders, unseen)
    assert np.allclose(got, plain_kneser_ney(train, wanted), atol=1e-4)


def test_quality_score_against_a_direct_computation(spark):
    import zstandard
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    marked = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    model = quality.fit_on_tables(docs, marked, ~quality.held_out("doc_id", 5, 0))
    rows = {r["doc_id"]: r["text"] for r in docs.orderBy("doc_id").limit(150).collect()}
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    for i, text in rows.items():
        raw = (text or "").encode()
        if not raw:
            assert got[i] == model.prior
            continue
        sizes = []
        for data, trained in zip(model.dictionaries, model.trained, strict=True):
            kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
            packer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(data, dict_type=kind), level=quality.LEVEL,
                                              write_content_size=False, write_checksum=False, write_dict_id=False)
            sizes.append(sum(len(packer.compress(raw[k:k + 1024])) for k in range(0, len(raw), 1024)))
        gain, size = (sizes[0] - sizes[1]) / len(raw), np.log1p(len(raw))
        x = [1.0, gain, gain * size, size]
        z = sum(w * (v - m) / s for w, v, m, s in zip(model.weights, x, model.mean, model.scale, strict=True))
        assert got[i] == pytest.approx(1 / (1 + np.exp(-z)), abs=2e-2)


def test_samples_are_bounded_and_repeatable(spark):
    """A dirty language column, a key with many texts: the models learn from bounded, repeatable samples."""
    rows = [(i, f"some english words of document {i} and the sea", "en") for i in range(40)]
    rows += [(i, f"einige deutsche wörter im dokument {i} und die see", "de") for i in range(40, 70)]
    rows += [(1000, f"text {i} of one key", "en") for i in range(300)] + [(2000 + i, f"dirt {i}", f"x{i}") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    models = [language_id.fit_on_table(docs.repartition(k), F.lit(True), max_languages=2) for k in (2, 7)]
    assert models[0].languages == ("de", "en")
    assert all(np.array_equal(a.log_p, b.log_p) for a, b in zip(models[0].orders, models[1].orders, strict=True))
    labels = docs.select("doc_id", F.when(F.col("doc_id") < 40, 1).otherwise(0).alias("quality")).distinct()
    fits = [quality.fit_on_tables(docs.repartition(k), labels, F.lit(True)) for k in (2, 7)]
    assert fits[0] == fits[1]
