"""Helpers shared by the operators: shared-folder tables, text chunks, columns."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careflow.session import scratch_path, ship_code

#: Code points that one numpy pass works on; one longer text is a chunk of its own.
CHUNK_CHARS = 400_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)  # the workers import this package
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder (``spark.checkpoint.dir``)
    and read it back.  This cuts lineage: a lost executor costs no recomputation
    of what has been written, and every reader sees the same rows."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def chunks(frames: Iterable[pd.DataFrame], column: str = "text",
           limit: int = CHUNK_CHARS) -> Iterator[tuple[pd.DataFrame, list[str]]]:
    """Cut batches into runs of rows with at most ``limit`` code points of text
    (a longer single text stands alone, whole); null texts become empty."""
    for frame in frames:
        if not len(frame):
            continue
        texts = ["" if t is None or t != t else t for t in frame[column].tolist()]
        first, size = 0, 0
        for i, text in enumerate(texts):
            if i > first and size + len(text) > limit:
                yield frame.iloc[first:i], texts[first:i]
                first, size = i, 0
            size += len(text)
        yield frame.iloc[first:], texts[first:]


def keyed_texts(docs: DataFrame, key: str) -> DataFrame:
    """key (as a string), text: what goes to a function on frames.  A numeric key
    beside a null one would become a float there, and large ones would change."""
    return docs.select(F.col(key).cast("string").alias("key"), "text")


def with_key(found: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """``found`` with its string column ``key`` turned back into that of ``docs``."""
    others = [c for c in found.columns if c != "key"]
    return found.select(F.col("key").cast(docs.schema[key].dataType).alias(key), *others)


def text_udf(schema: str, prepare: Callable[[], Callable[[list[str]], pd.DataFrame]]):
    """A column function over whole texts.  ``prepare`` runs once in each worker
    and gives the function that maps texts to as many rows of ``schema`` (null
    texts come as empty ones).  Other columns never leave the JVM."""

    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        work = prepare()
        for series in batches:
            parts = [work(texts) for _, texts in chunks([series.to_frame("text")])]
            yield pd.concat(parts, ignore_index=True) if parts else work([])

    return run
