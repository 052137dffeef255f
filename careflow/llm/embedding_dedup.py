"""Near-duplicate vectors by a subspace pigeonhole join (operator 5).

Unit vectors whose cosine is at least c have a squared distance of at most
2 - 2 c.  The vectors are rotated and cut into BLOCKS blocks of coordinates;
each block gets a share of that distance in proportion to its dimension.  Two
close vectors must keep within the share in some block, so they are found by a
range join in each block: the first coordinate, in cells as wide as the block's
radius, decides which vectors meet (a cell and its right neighbour), then the
block's distance, then the exact cosine.  A pair counts in the first block that
finds it.

Equal vectors of one label are one representative with a multiplicity and a
number of its own; keys come in only at the end, so a key that repeats with
another vector or label joins nothing.  Tasks hold bounded
parts of a cell and give numbers of links and a spanning set of links, never
lists of all pairs.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careflow.llm.common import materialise
from careflow.llm.components import connected_components

BLOCKS = 4
#: Vectors of one part of a cell on average; a task compares two parts.
PART = 4096
#: Rows of one matrix of distances.
STRIPE = 512
#: Room for rounding in the filters; the cosine itself has none.
_SLACK = 1e-9


@lru_cache(maxsize=8)
def rotation(dimension: int) -> np.ndarray:
    """A fixed random rotation, so that no block holds more than its share of the
    directions in which vectors differ."""
    draw = np.random.default_rng(dimension).standard_normal((dimension, dimension))
    q, r = np.linalg.qr(draw)
    return q * np.sign(np.diag(r))


def bounds(dimension: int, blocks: int = BLOCKS) -> list[int]:
    """First coordinate of each block (and the end); fewer blocks if there are
    fewer coordinates."""
    blocks = min(blocks, dimension)
    return [round(i * dimension / blocks) for i in range(blocks + 1)]


def budgets(dimension: int, cosine: float) -> np.ndarray:
    """Each block's share of the squared distance."""
    edges = bounds(dimension)
    return (2 - 2 * cosine) * np.diff(edges) / dimension * (1 + _SLACK) + _SLACK


def usable(vector: str, label: str, key: str) -> Column:
    """Vectors that can link: key, label and all components there, finite, not all zero."""
    v = F.col(vector)
    sound = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return F.coalesce(F.col(key).isNotNull() & F.col(label).isNotNull() & v.isNotNull() & sound
                      & F.exists(v, lambda x: x != 0), F.lit(False))


def _placed(cosine: float):
    """Column function: rotated unit vector and its cell in every block."""

    @F.pandas_udf("unit array<double>, cells array<long>")
    def place(vectors: pd.Series) -> pd.DataFrame:
        units: list = [None] * len(vectors)
        cells: list = [None] * len(vectors)
        rows = [np.asarray(v, np.float64) for v in vectors]
        for d in {len(r) for r in rows}:
            at = [i for i, r in enumerate(rows) if len(r) == d]
            x = np.stack([rows[i] for i in at])
            x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow of squares
            x = x / np.sqrt((x * x).sum(axis=1, keepdims=True)) @ rotation(d).T
            radius = np.sqrt(budgets(d, cosine)) * (1 + 1e-6)
            cell = np.floor(x[:, bounds(d)[:-1]] / radius).astype(np.int64)
            for i, u, c in zip(at, x, cell, strict=True):
                units[i], cells[i] = u, c
        return pd.DataFrame({"unit": units, "cells": cells})

    return place


def _joiner(cosine: float):
    """The function that compares two parts of a cell (or one with itself)."""

    def join(group: pd.DataFrame) -> pd.DataFrame:
        block, one, two = (int(group[c].iloc[0]) for c in ("block", "one", "two"))
        x = np.stack(group["unit"].to_numpy())
        d = x.shape[1]
        edges, share = bounds(d), budgets(d, cosine)
        part, guest = group["part"].to_numpy(), group["guest"].to_numpy()
        ids, copies = group["rep"].to_numpy(), group["copies"].to_numpy()
        left = np.flatnonzero(part == one)
        right = left if one == two else np.flatnonzero(part == two)
        own = x[:, edges[block]:edges[block + 1]]
        square = (own * own).sum(axis=1)
        pairs_a, pairs_b = [], []
        for s in range(0, len(left), STRIPE):
            rows = left[s:s + STRIPE]
            near = square[rows][:, None] + square[right][None, :] - 2 * own[rows] @ own[right].T <= share[block] + _SLACK
            near &= ~((guest[rows] == 1)[:, None] & (guest[right] == 1)[None, :])
            i, j = np.nonzero(near)
            i, j = rows[i], right[j]
            if one == two:
                keep = i < j
                i, j = i[keep], j[keep]
            for c in range(0, len(i), 100_000):
                a, b = i[c:c + 100_000], j[c:c + 100_000]
                apart = np.add.reduceat((x[a] - x[b]) ** 2, edges[:-1], axis=1) <= share
                first = apart[:, block] & ~apart[:, :block].any(axis=1)
                a, b = a[first], b[first]
                close = np.einsum("ij,ij->i", x[a], x[b]) >= cosine
                pairs_a.append(a[close])
                pairs_b.append(b[close])
        a = np.concatenate(pairs_a) if pairs_a else np.zeros(0, np.int64)
        b = np.concatenate(pairs_b) if pairs_b else np.zeros(0, np.int64)
        n = np.bincount(a, copies[b], len(x)) + np.bincount(b, copies[a], len(x))
        label = np.arange(len(x))
        while True:  # smallest place of each component of this task
            new = label.copy()
            np.minimum.at(new, a, label[b])
            np.minimum.at(new, b, label[a])
            new = new[new]
            if (new == label).all():
                break
            label = new
        linked = np.flatnonzero(n > 0)
        joined = np.flatnonzero(label != np.arange(len(x)))
        return pd.DataFrame({
            "a": np.concatenate([ids[linked], ids[joined]]),
            "b": pd.array(np.concatenate([np.zeros(len(linked), np.int64), ids[label[joined]]]), dtype="int64"),
            "n": np.concatenate([n[linked].astype(np.int64), np.zeros(len(joined), np.int64)])})

    return join


def near_duplicate_vectors(table: DataFrame, cosine: float = 0.93, key: str = "vec_id", vector: str = "embedding",
                           label: str = "label") -> DataFrame:
    """Links between vectors of one label whose cosine is at least ``cosine``.

    One row per input row: key, n_links (other vectors linked directly),
    component_id (smallest key reachable by links, itself included), kept (key =
    component_id).  Vectors that are null, zero or hold null or non-finite
    components, and rows without a label, link with nothing.  Rows with a null
    key link with nothing and are kept (component_id null).  Vectors of other
    lengths never meet.  Rows that repeat a key are vectors like others.  Other
    columns are ignored; an empty table gives an empty result."""
    rows = table.select(F.col(key).alias("id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    rows = rows.withColumn("ok", usable("vector", "label", "id"))
    sound = rows.filter("ok")
    reps = materialise(
        sound.groupBy("label", "vector").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
        .withColumns({"place": _placed(cosine)("vector"), "rep": F.monotonically_increasing_id()})
        .select("label", "vector", "rep", "least", "copies", F.col("place.unit").alias("unit"), F.col("place.cells").alias("cells")),
        "vectors")
    homes = reps.select("label", F.size("unit").alias("d"), "rep", "copies", "unit",
                        F.posexplode("cells").alias("block", "cell"))
    met = homes.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("guest")).withColumn(
        "cell", F.col("cell") - F.col("guest"))
    where = ["label", "d", "block", "cell"]
    parts = materialise(met.groupBy(*where).agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
                        , "cells")  # a row a cell
    dealt = met.join(parts, where).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    tasks = (dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .withColumn("one", F.least("part", "with")).withColumn("two", F.greatest("part", "with"))
             .select(*where, "one", "two", "part", "guest", "rep", "copies", "unit"))
    found = materialise(tasks.groupBy(*where, "one", "two").applyInPandas(_joiner(cosine), "a long, b long, n long"), "found")
    counts = found.filter("n > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    components = connected_components(found.filter("n = 0").select("a", "b")).withColumnRenamed("node", "rep")
    known = reps.select("label", "vector", "rep", "least", "copies").join(components, "rep", "left")
    smallest = known.filter("component is not null").groupBy("component").agg(F.min("least").alias("smallest"))
    of_rep = (known.join(smallest, "component", "left").join(counts, "rep", "left")
              .select("label", "vector", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                      F.coalesce("smallest", "least").alias("component"), F.lit(True).alias("ok")))
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return (rows.join(of_rep, ["ok", "label", "vector"], "left")
            .select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")))
