"""What filters remove together, in every order (operator 12).

A document's failure mask has a bit for every filter that it fails.  Spark
counts the documents of each mask within each part; all that follows works on
those counts, whose number is bounded by parts times masks.

For each part a decision diagram is built over the counts: a node tests one
filter, its two edges lead to the documents that pass and that fail, equal
nodes are shared, and every node carries the counts of its documents.  Swapping
two adjacent levels rewrites the nodes of the upper one only, so all orders of
the filters are visited by swaps of neighbours (plain changes).  In each order
the path that passes every filter gives the steps: a node's fail edge is what
the step removes, its pass edge what it keeps.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careflow.llm.common import materialise

#: Counts of a node: documents, good ones, toxic ones.
Counts = tuple[int, int, int]
_NONE: Counts = (0, 0, 0)


def _plus(a: Counts, b: Counts) -> Counts:
    return a[0] + b[0], a[1] + b[1], a[2] + b[2]


class Diagram:
    """An ordered decision diagram of weighted masks, with shared nodes.

    A node is a key of ``weight``; level i of ``order`` tests filter order[i].
    A leaf is its own counts; an inner node is (level, pass child, fail child).
    Only nodes below the root path matter, so a table of nodes is kept by
    structure: equal (level, pass, fail) is one node."""

    def __init__(self, masks: dict[int, Counts], n: int):
        self.order = list(range(n))
        self.n = n
        self.made: dict[tuple, int] = {}       # (level, pass, fail) or (n, counts) -> node
        self.nodes: list[tuple] = []
        self.weight: list[Counts] = []
        row = [self._leaf(masks.get(m, _NONE)) for m in range(1 << n)]
        for level in reversed(range(n)):       # bit 0 is tested first: neighbours differ in the last bit
            half = 1 << level
            row = [self._node(level, row[m], row[m | half]) for m in range(half)]
        self.root = row[0]

    def _leaf(self, counts: Counts) -> int:
        return self._add((self.n, counts), counts)

    def _node(self, level: int, passed: int, failed: int) -> int:
        return self._add((level, passed, failed), _plus(self.weight[passed], self.weight[failed]))

    def _add(self, key: tuple, weight: Counts) -> int:
        if key not in self.made:
            self.made[key] = len(self.nodes)
            self.nodes.append(key)
            self.weight.append(weight)
        return self.made[key]

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and ``level + 1``: each node of the upper
        level regroups its four grandchildren; what lies below stays as it is."""
        done: dict[int, int] = {}

        def moved(node: int) -> int:
            if node not in done:
                at, passed, failed = self.nodes[node]
                if at < level:
                    done[node] = self._node(at, moved(passed), moved(failed))
                else:
                    _, pp, pf = self.nodes[passed]
                    _, fp, ff = self.nodes[failed]
                    done[node] = self._node(level, self._node(level + 1, pp, fp), self._node(level + 1, pf, ff))
            return done[node]

        self.root = moved(self.root)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[int, Counts, Counts]]:
        """(filter, kept counts, removed counts) along the path that passes all."""
        node = self.root
        for tested in self.order:
            _, passed, failed = self.nodes[node]
            yield tested, self.weight[passed], self.weight[failed]
            node = passed

    def forget(self) -> None:
        """Drop nodes that the root does not reach (swaps leave them behind)."""
        nodes, weight = self.nodes, self.weight
        self.made, self.nodes, self.weight = {}, [], []
        new: dict[int, int] = {}

        def keep(node: int) -> int:
            if node not in new:
                key = nodes[node]
                new[node] = self._add(key if len(key) == 2 else (key[0], keep(key[1]), keep(key[2])), weight[node])
            return new[node]

        self.root = keep(self.root)


def plain_changes(n: int) -> Iterator[int]:
    """Levels to swap (with the next one), so that all n! orders are visited once:
    the largest element runs to and fro through the orders of the others."""
    if n < 2:
        return
    down = True
    for below in [*plain_changes(n - 1), None]:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        if below is not None:
            yield below + (1 if down else 0)
        down = not down


def audit(masks: dict[int, Counts], letters: str) -> list[tuple]:
    """(filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley) for every order of the filters and every step.
    ``masks``: counts of the documents of each failure mask (bit i: letters[i])."""
    n = len(letters)
    failing = [sum(c[0] for m, c in masks.items() if m >> i & 1) for i in range(n)]
    alone = [masks.get(1 << i, _NONE)[0] for i in range(n)]
    total = [0] * n
    rows = []
    diagram = Diagram(masks, n)
    swaps = plain_changes(n)
    while True:
        name = "".join(letters[i] for i in diagram.order)
        for step, (i, kept, gone) in enumerate(diagram.steps(), 1):
            total[i] += gone[0]
            rows.append((name, step, kept[0], gone[0], failing[i] - gone[0], alone[i], gone[1], gone[2], i))
        level = next(swaps, None)
        if level is None:
            break
        diagram.swap(level)
        diagram.forget()
    return [(*row[:-1], total[row[-1]]) for row in rows]


_STEPS = ("array<struct<filter_order: string, step: int, kept: long, removed: long, redundant: long, "
          "unique_fails: long, good_lost: long, toxic_lost: long, shapley: long>>")


def filter_interactions(failures: DataFrame, filters: Sequence[str], part: str, good: str, toxic: str) -> DataFrame:
    """Steps of every order of the filters within every part.

    ``failures`` has one row per document: a boolean column for each name in
    ``filters`` (single letters; true: the document fails; null counts as
    false), the part, and two boolean columns that mark good and toxic documents.
    A null part is the empty string.  One row per part, filter_order and step;
    an empty table gives an empty result.  The number of orders is the factorial
    of the number of filters, so at most seven are taken."""
    letters = "".join(filters)
    if len(letters) != len(filters) or len(set(letters)) != len(letters) or not 1 <= len(letters) <= 7:
        raise ValueError("one to seven filters with names of one letter each")

    @F.pandas_udf(_STEPS)
    def orders(cells: pd.Series) -> pd.Series:
        names = ["filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
        return pd.Series([[dict(zip(names, row, strict=True)) for row in
                           audit({c["mask"]: (c["n"], c["good"], c["toxic"]) for c in of_part}, letters)]
                          for of_part in cells], dtype=object)

    def flag(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(False)).cast("long")

    mask = sum((flag(f) * (1 << i) for i, f in enumerate(letters)), F.lit(0))
    cells = (failures.select(F.coalesce(F.col(part), F.lit("")).alias("part"), mask.cast("int").alias("mask"),
                             flag(good).alias("good"), flag(toxic).alias("toxic"))
             .groupBy("part", "mask").agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")))
    by_part = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    return by_part.select("part", F.explode(orders("cells")).alias("s")).select("part", "s.*")


FILTERS = "ABCDE"
_BLANK = r"[\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def document_failures(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """doc_id, part, A to E (true: fails), good, toxic of every document.

    A: under 100 words; B: fewer than 80 distinct words of 100; C: more than one
    in ten characters is A-Z; D: holds one of ``#$%&*|``; E: a smaller doc_id has
    the same text (null is the empty text; a row without a doc_id has none
    smaller and is smaller than none).  good and toxic: some label row of the
    doc_id says quality 1, toxic 1.  One row per input row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split("body", _BLANK), lambda w: w != "")
    facts = docs.select(F.col("doc_id"), F.coalesce(F.col(part), F.lit("")).alias("part"), text.alias("body")).select(
        "doc_id", "part", F.xxhash64("body").alias("h1"), F.xxhash64(F.lit(1), "body").alias("h2"),
        F.length("body").cast("long").alias("n_chars"), words.alias("words"),
        (F.length("body") - F.length(F.translate("body", _UPPER, ""))).cast("long").alias("upper"),
        F.col("body").rlike(r"[#$%&*|]").alias("D"))
    judged = materialise(facts.select(
        "doc_id", "part", "h1", "h2", "n_chars", (F.size("words") < 100).alias("A"),
        (100 * F.size(F.array_distinct("words")).cast("long") < 80 * F.size("words").cast("long")).alias("B"),
        (100 * F.col("upper") > 10 * F.col("n_chars")).alias("C"), "D"), "failures")
    same = ["h1", "h2", "n_chars"]
    first = (judged.filter("doc_id is not null").groupBy(*same)
             .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first <> last").drop("last"))
    marked = (labels.filter("doc_id is not null").groupBy("doc_id")
              .agg(F.max((F.col("quality") == 1)).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")))
    return (judged.join(first, same, "left").join(marked, "doc_id", "left")
            .select("doc_id", "part", "A", "B", "C", "D",
                    F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).alias("E"),
                    F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")))
