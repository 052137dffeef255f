import re

import corpus_pipeline
from careflow.llm import language_id, minhash_dedup, pii, quality, queries
from careflow.llm.common import materialise
from tests.llm.conftest import SF_CHECK
from tests.llm.test_near_duplicates import brute


def test_every_operator_has_a_query():
    import __spark_entry__ as entry
    names = list(entry.queries())
    for n in range(1, 11):
        assert sum(re.match(rf"op{n}_", x) is not None for x in names) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality", "near_duplicates", "personal_data", "packing"]


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = materialise(stage(spark, docs, SF_CHECK), "test")
        kept.append((name, docs, out))
        if name != "packing":
            assert out.columns == columns and out.dtypes == docs.dtypes
        docs = out
    rows = {name: ({r["doc_id"]: r for r in a.collect()}, {r["doc_id"]: r for r in b.collect()}) for name, a, b in kept}
    before, after = rows["language_id"]
    models = language_id.fit_on_table(kept[0][1], ~quality.held_out("doc_id", 4, 2))
    rejected = {r["doc_id"] for r in language_id.identify(kept[0][1], models).filter("rejected").collect()}
    assert set(after) == set(before) - rejected and len(rejected) < 20
    before, after = rows["quality"]
    marked = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    model = quality.fit_on_tables(kept[1][1], marked, ~quality.held_out("doc_id", 5, 0))
    bad = {r["doc_id"] for r in quality.score(kept[1][1], model).filter("score < 0.3").collect()}
    assert set(before) - set(after) == bad
    labels = {r["doc_id"]: r["quality"] for r in marked.collect()}
    assert sum(labels.get(i) == 1 for i in bad) <= 0.01 * sum(labels.values())  # clean documents stay
    assert sum(labels.get(i) == 0 for i in bad) >= 0.8 * sum(q == 0 for q in labels.values())
    before, after = rows["near_duplicates"]
    component, _ = brute({i: r["text"] for i, r in before.items()}, 80)
    assert set(after) == {i for i, c in component.items() if i == c}
    before, after = rows["personal_data"]
    assert set(after) == set(before)
    for i, r in after.items():
        found = pii.find(before[i]["text"])
        assert (r["text"] != before[i]["text"]) == bool(found) and r["n_chars"] == len(r["text"])
        assert not any(before[i]["text"][a:b] in r["text"] for a, b, _, _ in found)
    before, _ = rows["packing"]
    pieces = kept[-1][2].collect()
    assert {p["doc_id"] for p in pieces} == set(before)


def test_pipeline_of_an_odd_table(spark, odd_docs, no_docs):
    docs = odd_docs.drop("text", "n_chars").select("*")
    assert "text" not in docs.columns
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES[2:]:
        out = materialise(stage(spark, docs, SF_CHECK), "test")
        if name == "near_duplicates":
            ids = [r["doc_id"] for r in out.collect()]
            assert sorted(i for i in ids if i is not None) == [
                -2**62 - 5, 1, 2, 3, 4, 5, 7, 7, 20, 41, 42, 2**53 + 1, 2**53 + 3, 2**62 + 5] and ids.count(None) == 3
        if name != "packing":
            assert out.columns == docs.columns
            docs = out
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF_CHECK).count() == 0


def test_near_duplicates_of_one_key_and_of_many(spark):
    """A key that repeats with another text does not tie its texts together; of a
    group one row stays, also where its rows share the key; a pair of 0.8 is found."""
    words = [f"w{i}" for i in range(44)]
    near = words[:-4] + ["other", "end", "of", "it"]       # 36 of 44 shingles: 0.818
    rows = [(5, "a b c d e f g h i j k l m n"), (5, "p q r s t u v w x y"), (1, "a b c d e f g h i j k l m n o"),
            (9, " ".join(words)), (9, " ".join(near)), (9, " ".join(near)), (None, "p q r s t u v w x y")]
    docs = spark.createDataFrame([(i, t, "en", "a", 1, "z") for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, _row string")
    out = corpus_pipeline.drop_near_duplicates(spark, docs, SF_CHECK)
    got = sorted((str(r["doc_id"]), r["text"], r["_row"]) for r in out.collect())
    assert out.columns == docs.columns and [g[:2] for g in got if g[0] != "9"] == [
        ("1", "a b c d e f g h i j k l m n o"), ("5", "p q r s t u v w x y"), ("None", "p q r s t u v w x y")]
    assert sum(g[0] == "9" for g in got) == 1 and {g[2] for g in got} == {"z"}


def test_parameters_are_those_of_the_contract():
    assert minhash_dedup.WORDS == 5 and queries.RANK_FILE == "byte_bpe_multi_50k.tiktoken"
