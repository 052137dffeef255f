import itertools
import math
import random

import pytest

from careflow.llm import filter_audit
from tests.llm.conftest import SF_CHECK


def brute(rows, letters):
    """rows: (part, failing letters, good, toxic); counts by applying every order to the rows."""
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        removed_by = dict.fromkeys(letters, 0)
        for order in itertools.permutations(letters):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                removed_by[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in r[1] for r in mine) - len(gone), sum(r[1] == f for r in mine),
                    sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(removed_by[order[step - 1]])
    return out


def test_plain_changes_visit_every_order_once():
    for n in range(1, 7):
        order = list(range(n))
        seen = [tuple(order)]
        for level in filter_audit.plain_changes(n):
            order[level], order[level + 1] = order[level + 1], order[level]
            seen.append(tuple(order))
        assert len(seen) == len(set(seen)) == math.factorial(n)


def test_diagrams_share_equal_nodes():
    d = filter_audit.Diagram({m: (1, 0, 0) for m in range(32)}, 5)
    assert len(d.nodes) == 6            # one node a level: all subtrees are equal
    for level in (0, 3, 1, 2, 0):
        d.swap(level)
        d.forget()
        assert len(d.nodes) == 6 and d.weight[d.root] == (32, 0, 0)


@pytest.mark.parametrize("letters", ["A", "BA", "XYZ", "ABCDE"])
def test_random_failures(spark, letters):
    draw = random.Random(len(letters))
    rows = []
    for _ in range(120):
        fails = "".join(f for f in letters if draw.random() < 0.4)
        rows.append((draw.choice(["en", "", None, "de"]), fails, draw.random() < 0.3, draw.random() < 0.1))
    flags = [(p, g, t, *(f in fails or (None if i % 2 else False) for i, f in enumerate(letters))) for p, fails, g, t in rows]
    schema = "lang string, good boolean, toxic boolean, " + ", ".join(f"{f} boolean" for f in letters)
    table = spark.createDataFrame(flags, schema)
    got = {tuple(r[:3]): list(r[3:]) for r in
           filter_audit.filter_interactions(table, letters, "lang", "good", "toxic").collect()}
    assert got == brute([(p or "", "".join(sorted(f, key=letters.index)), g, t) for p, f, g, t in rows], letters)


def test_failures_of_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(7, 1, 0), (7, 0, None), (20, None, 1), (None, 1, 1), (99, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    docs = odd_docs.withColumnRenamed("quality", "h1").withColumnRenamed("score", "first")
    got = filter_audit.document_failures(docs, labels).collect()
    rows = [(r["doc_id"], r["text"] or "", r["lang"] or "") for r in odd_docs.collect()]
    want = []
    for i, text, part in rows:
        words = [w for w in text.replace("\t", " ").replace("\n", " ").split(" ") if w]
        smaller = i is not None and any(j is not None and j < i and t == text for j, t, _ in rows)
        want.append((i, part, len(words) < 100, 100 * len(set(words)) < 80 * len(words),
                     100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text), any(c in "#$%&*|" for c in text),
                     smaller, i == 7, i == 20))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    empty = filter_audit.document_failures(no_docs, labels)
    assert filter_audit.filter_interactions(empty, "ABCDE", "part", "good", "toxic").collect() == []
    with pytest.raises(ValueError):
        filter_audit.filter_interactions(empty, "AA", "part", "good", "toxic")


def test_query_against_brute_force(spark):
    from careflow.llm.queries import QUERIES
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    judged = filter_audit.document_failures(docs, labels).collect()
    rows = [(r["part"], "".join(f for f in "ABCDE" if r[f]), r["good"], r["toxic"]) for r in judged]
    got = {(r["part"], r["filter_order"], r["step"]): list(r[3:]) for r in QUERIES["op12_filter_audit"](spark, SF_CHECK).collect()}
    assert got == brute(rows, "ABCDE")
