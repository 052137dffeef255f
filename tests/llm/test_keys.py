"""Keys come back as they went in: large ones beside null ones, from every operator."""
from collections import Counter

import public_tokenizers
import pytest

from careflow.llm import bpe, filter_audit, language_id, line_dedup, minhash_dedup, packing, pii, quality, simhash, token_counts
from careflow.llm.queries import MERGE_FILE, RANK_FILE

RUNS = {
    "op2": lambda d: minhash_dedup.near_duplicates(d),
    "op4": lambda d: packing.best_fit_packing(d, public_tokenizers.path(MERGE_FILE)),
    "op6": lambda d: bpe.encode_digest(d, public_tokenizers.path(RANK_FILE)),
    "op7": lambda d: simhash.edited_fingerprints(d),
    "op8": lambda d: token_counts.token_counts(d, public_tokenizers.path(MERGE_FILE)),
    "op9": lambda d: pii.with_surrogates(d, "secret"),
    "op11": lambda d: line_dedup.line_bitmaps(d),
    "op12": lambda d: filter_audit.document_failures(d, d.selectExpr("doc_id", "1 as quality", "0 as toxic")),
}


@pytest.mark.parametrize("name", RUNS)
def test_keys_are_unchanged(odd_docs, name):
    docs = odd_docs.filter("doc_id <> 41 or doc_id is null").coalesce(1)     # one batch: large keys beside null ones
    keys = Counter(r["doc_id"] for r in docs.select("doc_id").collect())
    out = RUNS[name](docs)
    got = Counter(r["doc_id"] for r in out.select("doc_id").collect())
    assert got.keys() == keys.keys()
    if name not in ("op4", "op8"):      # those give several rows a document
        assert got == keys


@pytest.mark.parametrize("name", RUNS)
def test_keys_of_text_type(spark, name):
    if name in ("op2", "op7", "op11"):
        pytest.skip("an integral key is asked for")
    docs = spark.createDataFrame([("a-1", "some text here"), (None, "more"), ("007", None)], "doc_id string, text string")
    docs = docs.selectExpr("*", "'en' as lang")
    assert {r["doc_id"] for r in RUNS[name](docs).select("doc_id").collect()} == {"a-1", None, "007"}


def test_predictions_keep_keys(spark, odd_docs):
    model = quality.fit(["good text of words " * 30] * 40 + ["!! buy ### now" * 30] * 40, [1] * 40 + [0] * 40, 0.5)
    keys = Counter(r["doc_id"] for r in odd_docs.select("doc_id").collect())
    assert Counter(r["doc_id"] for r in quality.score(odd_docs, model).collect()) == keys
    models = language_id.fit_on_table(odd_docs.filter("lang is not null"), odd_docs["doc_id"].isNotNull())
    assert Counter(r["doc_id"] for r in language_id.identify(odd_docs, models).collect()) == keys
