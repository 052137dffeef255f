import hashlib
import random

import pandas as pd
from pyspark.sql import functions as F

from careflow.llm import line_dedup

BLANKS = " \t\n\x0b\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    """(id, text) -> kept text, by a dictionary of the smallest id of every key."""
    def place(i):
        return (i is None, i or 0)

    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(line.strip(BLANKS).translate(LOWER), set()).add(place(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        keys = [x.strip(BLANKS).translate(LOWER) for x in lines]
        kept = [x for x, k in zip(lines, keys, strict=True) if len(k) < 10 or min(holders[k]) == place(i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def found(docs):
    out = line_dedup.line_bitmaps(docs).select(
        "doc_id", "n_lines", "n_dropped", line_dedup.kept_sha256(F.col("text"), F.col("keep_bitmap")))
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_random_lines(spark):
    draw = random.Random(11)
    pool = ["Short", " The same line, again ", "THE SAME LINE, AGAIN", "0123456789", "\tÄ line of Umlauts\r", "", "x" * 9, "x" * 10,
            *(f"line number {i} of the pool" for i in range(12))]
    rows = [(draw.choice([None, *range(40), 2**53 + 1, 2**53 + 3, -2**62 - 5]),
             "\n".join(draw.choices(pool, k=draw.randrange(9))) if draw.random() < 0.95 else None) for _ in range(150)]
    rows += rows[:5]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(docs) == brute(rows)


def test_a_line_that_all_documents_hold_is_cut_into_tasks(spark):
    rows = [(i, f"A line that everybody has\nown line of {i} here\nA line that everybody has") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs) == brute(rows)


def test_tasks_that_share_a_hash():
    """A hash may begin in an earlier task: its rows wait, both ends are told."""
    rows = pd.DataFrame({"h1": [1, 1, 2, 2, 2, 3], "h2": 0, "no_doc": 0, "doc": [4, 5, 1, 1, 9, 7], "copy": 0, "pos": range(6)})
    whole = pd.concat(line_dedup._first_occurrences(iter([rows])))
    pieces = pd.concat(line_dedup._first_occurrences(iter([rows.iloc[:0], *(rows.iloc[i:i + 1] for i in range(6))])))
    as_set = lambda f: sorted(map(tuple, f.astype("int64").values.tolist()))
    assert as_set(whole) == as_set(pieces)
    told = [(w, h, d) for w, h, d in zip(whole["what"], whole["h1"], whole["doc"], strict=True)]
    assert sorted(told) == [(0, 2, 9), (1, 1, 4), (1, 1, 5), (2, 1, 4), (2, 3, 7)]


def test_odd_table(spark, odd_docs, no_docs):
    out = line_dedup.line_bitmaps(odd_docs)
    assert out.columns == [*odd_docs.columns, "n_lines", "n_dropped", "keep_bitmap"] and out.count() == odd_docs.count()
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert found(odd_docs) == brute(rows)
    assert line_dedup.line_bitmaps(no_docs).collect() == []
    text = out.select("text", line_dedup.kept_text(F.col("text"), F.col("keep_bitmap")).alias("kept"), "n_dropped").collect()
    assert all(r["kept"] == (r["text"] or "") for r in text if not r["n_dropped"])
    assert {r["kept"] for r in text if r["n_dropped"]} == {""}
