"""A training corpus from the documents table, in five stages.

Every stage works on all that the one before kept; all but the last return the
columns of ``documents``.  ``run`` writes each stage's result as parquet in the
shared folder and reads it again as the next one's input.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careflow.llm import language_id, minhash_dedup, packing, pii, quality
from careflow.llm.common import materialise, read_table
from careflow.llm.queries import MERGE_FILE
from careflow.session import ship_code


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language the models reject (no letter, no clear
    language, or text unlike any language learned).  The models learn from the
    stage's own rows."""
    ship_code(spark)
    models = language_id.fit_on_table(docs, ~quality.held_out("doc_id", 4, 2))
    found = language_id.language_udf(spark, models)("text")
    return docs.filter(~found["rejected"])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality classifier predicts to be bad; it learns
    from the labels of the stage's own rows.  Texts without content have nothing
    to judge and stay or go by the share of good labels."""
    model = quality.fit_on_tables(docs, read_table(spark, sf_dir, "labels"), ~quality.held_out("doc_id", 5, 0))
    judged = quality.score_udf(model, 0.3)("text")
    return docs.filter(judged["predicted"] == 1)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group (similarity 0.8 or more), that
    with the smallest doc_id; of rows equal in doc_id and text one stays.  Rows
    without a doc_id belong to no group and stay."""
    ship_code(spark)
    rows = docs.select(F.struct(*docs.columns).alias("own"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("copy"))
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("copy"))
    found = minhash_dedup.near_duplicates(texts, percent=80, carry=("copy",)).filter("first and doc_id is not null")
    kept = materialise(found.groupBy(F.col("doc_id").alias("id"), "copy").agg((F.count("*") > 1).alias("repeated")), "kept")
    single = rows.join(kept.filter("not repeated"), ["id", "copy"], "left_semi")
    repeated = rows.join(kept.filter("repeated"), ["id", "copy"], "left_semi").groupBy("id", "copy").agg(F.first("own").alias("own"))
    nameless = rows.filter("id is null")
    return single.select("own").unionAll(repeated.select("own")).unionAll(nameless.select("own")).select("own.*")


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by surrogates, keyed by the secret of the Spark
    configuration (``spark.careflow.pii.secret``); n_chars follows the new text."""
    ship_code(spark)
    done = pii.with_surrogates(docs, pii.session_secret(spark))
    length = F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType))
    return done.withColumn("n_chars", F.coalesce(length, "n_chars"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all remaining documents in sequences of at most 1024 tokens."""
    ship_code(spark)
    return packing.best_fit_packing(docs, public_tokenizers.path(MERGE_FILE))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", replace_personal_data),
    ("packing", pack_sequences),
]

#: Models and tokenizers decide the rows; tests/llm compares them stage by stage
#: with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
