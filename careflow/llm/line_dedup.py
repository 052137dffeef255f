"""Lines that repeat across documents, as keep bitmaps (operator 11).

A line's key is the line without blanks at both ends, A-Z lower-cased.  A key
that is long enough and stands in several documents stays in the one with the
smallest id only.

Every such line becomes a small row: 128 bits of hash, document, position.  The
rows are range-partitioned on the hash *and* document and position, and sorted
by them, so a key that a third of all documents hold is cut into many tasks.
Each task streams over its rows and keeps the first document of every hash.  Of
the hash that a task starts with, an earlier task may hold the first document:
those rows wait, and are settled by the first documents that all tasks report
for the hashes at their two ends (two rows a task).  What comes out is one
compressed bitmap for each document that loses lines; no text is moved for it.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careflow.llm.common import materialise

LEAST_CHARS = 10
BLANKS = " \t\n\x0b\f\r"
#: Rows of one sorted task on average.
TASK_ROWS = 2_000_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ROW = ["no_doc", "doc", "copy"]


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), _UPPER, _UPPER.lower())


def _identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` with no_doc, doc (the key, never null) and copy (hash of the text,
    which tells rows of one key apart)."""
    return docs.withColumns({"no_doc": F.col(key).isNull().cast("int"),
                             "doc": F.coalesce(F.col(key).cast("long"), F.lit(0)),
                             "copy": F.xxhash64(F.coalesce(F.col(text), F.lit("")))})


def _lines(docs: DataFrame, key: str, text: str, least_chars: int) -> DataFrame:
    """h1, h2 (hashes of the key), no_doc, doc, copy, pos of every line with a long enough key."""
    body = F.coalesce(F.col(text), F.lit("")).alias("body")
    lines = (_identified(docs.select(key, text), key, text).select(*_ROW, body)
             .select(*_ROW, F.posexplode(F.split("body", "\n", -1)).alias("pos", "line"))
             .withColumn("line", line_key(F.col("line"))).filter(F.length("line") >= least_chars))
    return lines.select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), *_ROW, "pos")


#: What a row of the stream says.
DROP, WAIT, END = 0, 1, 2
_STREAM = "what int, h1 long, h2 long, no_doc int, doc long, copy long, pos int"


def _first_occurrences(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by hash, document and position: DROP for every row that is not
    in its hash's first document; of the hash that the task starts with, every
    row as WAIT; END for the first document of the first and the last hash."""
    first: tuple | None = None     # hash that the task starts with
    last: tuple | None = None      # hash and document that the group in hand starts with
    names = ["h1", "h2", "no_doc", "doc"]
    for frame in frames:
        if not len(frame):
            continue
        h1, h2, no_doc, doc = (frame[c].to_numpy() for c in names)
        starts = np.ones(len(frame), bool)
        starts[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        if last is not None:
            starts[0] = (h1[0], h2[0]) != last[:2]
        heads = np.flatnonzero(starts)
        group = np.cumsum(starts) - 1          # -1: the group in hand from the batch before
        head_no_doc, head_doc = no_doc[heads], doc[heads]
        if last is not None:
            head_no_doc = np.append(head_no_doc, last[2])   # index -1
            head_doc = np.append(head_doc, last[3])
        later = (no_doc != head_no_doc[group]) | (doc != head_doc[group])
        what = np.where(later, DROP, -1)
        if first is None:
            first = (h1[0], h2[0])
            yield pd.DataFrame([[END, h1[0], h2[0], no_doc[0], doc[0], 0, 0]],
                               columns=["what", *names, "copy", "pos"])
        what[(h1 == first[0]) & (h2 == first[1])] = WAIT
        told = what >= 0
        yield frame[told].assign(what=what[told].astype(np.int32))[["what", *names, "copy", "pos"]]
        if len(heads):
            i = heads[-1]
            last = (h1[i], h2[i], no_doc[i], doc[i])
    if last is not None and last[:2] != first:
        yield pd.DataFrame([[END, *last, 0, 0]], columns=["what", *names, "copy", "pos"])


def _bitmaps(n_lines: pd.Series, dropped: pd.Series) -> pd.Series:
    """zlib-compressed bits, one a line, first line in the highest bit; 1 stays.
    Null where nothing is dropped."""
    out: list[bytes | None] = []
    for n, gone in zip(n_lines.tolist(), dropped, strict=True):
        if gone is None:
            out.append(None)
            continue
        bits = np.ones(n, np.uint8)
        bits[np.asarray(gone, np.int64)] = 0
        out.append(zlib.compress(np.packbits(bits).tobytes()))
    return pd.Series(out, dtype=object)


def kept_lines(lines: list[str], bitmap: bytes | None) -> list[str]:
    """The lines that a bitmap keeps (all without a bitmap)."""
    if bitmap is None:
        return lines
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=len(lines))
    return [line for line, bit in zip(lines, bits.tolist(), strict=True) if bit]


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """Documents that lose lines: no_doc, doc (the key as long), copy (hash of the
    text), dropped (positions of the lost lines, from 0)."""
    spark = docs.sparkSession
    lines = materialise(_lines(docs, key, text, least_chars), "lines")
    order = ["h1", "h2", "no_doc", "doc", "copy", "pos"]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(lines.count() / TASK_ROWS))
    told = materialise(lines.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
                       .mapInPandas(_first_occurrences, _STREAM), "told")
    ends = (told.filter(F.col("what") == END).groupBy("h1", "h2")
            .agg(F.min(F.struct("no_doc", "doc")).alias("first")))       # two rows a task at most
    settled = (told.filter(F.col("what") == WAIT).join(F.broadcast(ends), ["h1", "h2"])
               .filter(F.struct("no_doc", "doc") != F.col("first")))
    gone = told.filter(F.col("what") == DROP).select(*_ROW, "pos").unionAll(settled.select(*_ROW, "pos"))
    return gone.groupBy(*_ROW).agg(F.collect_set("pos").alias("dropped"))


def line_bitmaps(docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """``docs`` with n_lines, n_dropped and keep_bitmap (null: all lines stay).

    A text is split at ``\\n`` (null or empty: one empty line).  Keys of at least
    ``least_chars`` code points that stand in at least two documents lose all
    their lines but those in the document with the smallest key.  The key must be
    integral.  Rows that repeat a key are parts of one document.  Rows with a
    null key are together one document that comes after all others.  All columns
    stay; columns of the same names as the three are replaced.  An empty table
    gives an empty result."""
    names = ["n_lines", "n_dropped", "keep_bitmap"]
    columns = [c for c in docs.columns if c not in names]
    lost = materialise(repeated_lines(docs, key, text, least_chars), "lost")
    body = F.coalesce(F.col(text), F.lit(""))
    whole = docs.select(F.struct(*columns).alias("own"), F.col(key).alias("id"), body.alias("body"),
                        F.size(F.split(body, "\n", -1)).cast("long").alias("n_lines"))
    joined = _identified(whole, "id", "body").select("own", *_ROW, "n_lines").join(lost, _ROW, "left")
    return joined.select("own.*", "n_lines",
                         F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
                         F.pandas_udf(_bitmaps, "binary")("n_lines", "dropped").alias("keep_bitmap"))


def _of_kept(text: Column, bitmap: Column, plain: Column, work: Callable[[str], str]) -> Column:
    """``plain`` where no line is lost, else ``work`` of the text without the lost
    lines; only such texts leave the JVM."""

    @F.pandas_udf("string")
    def run(texts: pd.Series, bitmaps: pd.Series) -> pd.Series:
        return pd.Series([None if b is None else work("\n".join(kept_lines((t or "").split("\n"), b)))
                          for t, b in zip(texts, bitmaps, strict=True)], dtype=object)

    return F.coalesce(run(F.when(bitmap.isNotNull(), text), bitmap), plain)


def kept_text(text: Column, bitmap: Column) -> Column:
    """The text without the lines that its bitmap drops (null: empty)."""
    body = F.coalesce(text, F.lit(""))
    return _of_kept(body, bitmap, body, lambda t: t)


def kept_sha256(text: Column, bitmap: Column) -> Column:
    """Lowercase hex digest of the UTF-8 bytes of ``kept_text``."""
    body = F.coalesce(text, F.lit(""))
    return _of_kept(body, bitmap, F.sha2(body, 256), lambda t: hashlib.sha256(t.encode()).hexdigest())
