"""Isolation forest (M3 fit, M4 score) on Spark.

Spark ML has no isolation forest; this follows the published algorithm
(Liu, Ting, Zhou 2008) with the usual defaults: 100 trees, sub-sample
psi = min(256, N), depth limit ceil(log2(psi)), random feature and a uniform
split between the node's min and max, anomaly score -2^(-E[h(x)] / c(psi)),
offset = the ``contamination`` quantile of the training scores.

Work split
* Sampling: every (row, tree) pair gets a uniform hash; a row is a candidate
  for a tree when its hash is below ~1.3 psi / N, so about 1.3 psi rows per
  tree leave the scan however large N is.  Each tree keeps its psi smallest
  hashes -- exactly a uniform sample without replacement.  A tree that drew
  fewer than psi candidates is redrawn with a larger threshold (exact).
* Growing: ``groupBy('tree').applyInPandas`` -- one small group per tree.
* Scoring: the node table is bounded by n_trees x (2^(depth+1) - 1) rows
  (about 51k for the defaults), so it is broadcast; rows are scored with a
  vectorised ``mapInPandas``.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EULER = 0.5772156649
# The node arrays are broadcast to every scoring task; n_trees x (2^(depth+1) - 1)
# nodes x 40 bytes must stay below this (about 2 MB for the defaults).
MAX_MODEL_BYTES = 256 << 20
# Rows that the last step of the exact quantile sorts; see ``exact_quantile``.
QUANTILE_ROWS = 100_000

NODE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()), T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.IntegerType()), T.StructField("split", T.DoubleType()),
    T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()),
    T.StructField("size", T.LongType()), T.StructField("depth", T.IntegerType()),
])


def average_path_length(n):
    """c(n): mean path length of an unsuccessful BST search; c(1) = 0, c(2) = 1."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    two = n == 2
    big = n > 2
    out[two] = 1.0
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def _grow_tree(X: np.ndarray, rng: np.random.Generator, max_depth: int, tree: int) -> list[tuple]:
    nodes: list[tuple] = []
    stack = [(0, np.arange(len(X)), 0)]
    next_id = 1
    while stack:
        nid, idx, depth = stack.pop()
        n = len(idx)
        feature, split, left, right = -1, 0.0, -1, -1
        if depth < max_depth and n > 1:
            sub = X[idx]
            lo, hi = sub.min(axis=0), sub.max(axis=0)
            usable = np.flatnonzero(hi > lo)
            if len(usable):
                q = int(rng.choice(usable))
                s = float(rng.uniform(lo[q], hi[q]))
                go_left = sub[:, q] <= s
                left, right = next_id, next_id + 1
                next_id += 2
                feature, split = q, s
                stack.append((right, idx[~go_left], depth + 1))
                stack.append((left, idx[go_left], depth + 1))
        nodes.append((tree, nid, feature, split, left, right, n, depth))
    return nodes


def _grower(features: list[str], psi: int, max_depth: int, seed: int):
    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        pdf = pdf.sort_values(["_h", "_k"]).head(psi)
        X = pdf[features].to_numpy(dtype=float)
        rng = np.random.default_rng([seed, tree])
        return pd.DataFrame(_grow_tree(X, rng, max_depth, tree), columns=NODE_SCHEMA.names)
    return grow


@dataclass
class ForestModel:
    nodes: pd.DataFrame            # NODE_SCHEMA rows
    features: list[str]
    psi: int
    n_trees: int
    max_depth: int
    offset: float = 0.0
    contamination: float = 0.05

    def arrays(self):
        """Dense (tree, node) arrays for vectorised traversal."""
        m = int(self.nodes["node"].max()) + 1
        shape = (self.n_trees, m)
        feat = np.full(shape, -1, dtype=np.int64)
        split = np.zeros(shape)
        left = np.zeros(shape, dtype=np.int64)
        right = np.zeros(shape, dtype=np.int64)
        size = np.zeros(shape)
        t, n = self.nodes["tree"].to_numpy(), self.nodes["node"].to_numpy()
        feat[t, n] = self.nodes["feature"].to_numpy()
        split[t, n] = self.nodes["split"].to_numpy()
        left[t, n] = self.nodes["left"].to_numpy()
        right[t, n] = self.nodes["right"].to_numpy()
        size[t, n] = self.nodes["size"].to_numpy()
        return feat, split, left, right, size


def _uniform_hash(seed: int, tree, key: str):
    """Uniform double in [0, 1) from (seed, tree, key)."""
    return (F.pmod(F.xxhash64(F.lit(seed), tree, F.col(key)), F.lit(1 << 53)).cast("double")
            / float(1 << 53))


def exact_quantile(df: DataFrame, column: str, share: float, n: int) -> float:
    """The exact ``share`` quantile (linear between order statistics) of the
    ``n`` values of a column, the same way at every size.

    ``percentile_approx`` brackets the rank, the rows below the bracket are
    counted, and the bracket narrows until few rows are inside; two order
    statistics of these give the value."""
    at = share * (n - 1)
    rank = int(math.floor(at))
    x = F.col(column)
    below, inside = 0, n
    rows = df.select(column)
    while inside > QUANTILE_ROWS:
        cut = [min(1.0, max(0.0, (rank - below + d) / inside)) for d in (-inside / 1000 - 2, inside / 1000 + 2)]
        a, b = rows.select(F.percentile_approx(column, cut, 10_000)).first()[0]
        got = rows.agg(F.count_if(x < a).alias("less"), F.count_if(x <= b).alias("upto")).first()
        if not got["less"] <= rank - below <= got["upto"] - 1 - (at > rank):
            break                          # the rank lies at the edge: sort what is inside
        narrowed = rows.filter((x >= a) & (x <= b))
        size = got["upto"] - got["less"]
        rows, below = narrowed, below + got["less"]
        if a == b:                         # one value fills the bracket
            return float(a)
        if size == inside:
            break
        inside = size
    two = [r[0] for r in rows.orderBy(column).offset(rank - below).limit(2).collect()]
    first, second = two[0], two[-1]
    return float(first + (at - rank) * (second - first))


def fit(df: DataFrame, features: list[str], key: str = "physician_id", n_trees: int = 100,
        max_samples: int = 256, contamination: float = 0.05, seed: int = 42,
        oversample: float = 1.3, return_scores: bool = False):
    """M3: grow the forest on ``df`` (one row per entity, numeric features) and
    set the offset so that ``contamination`` of the training rows score below 0.

    With ``return_scores`` the training rows' ``score_samples`` (checkpointed,
    they were needed for the offset anyway) are returned with the model."""
    spark = df.sparkSession
    data = df.select(F.col(key).alias("_k"), *[F.col(c).cast("double").alias(c) for c in features])
    n = data.count()
    if n == 0:
        raise ValueError("no training rows")
    psi = min(max_samples, n)
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    grow = _grower(features, psi, max_depth, seed)
    trees = list(range(n_trees))
    p = min(1.0, oversample * psi / n)
    parts = []
    while trees:
        # the trees that draw a row, found before it is repeated for each of them
        drawn = F.filter(F.array(*[F.lit(t) for t in trees]), lambda t: _uniform_hash(seed, t, "_k") < p)
        cand = (data.withColumn("tree", F.explode(drawn))
                .withColumn("_h", _uniform_hash(seed, F.col("tree"), "_k")))
        nodes = cand.groupBy("tree").applyInPandas(grow, NODE_SCHEMA).toPandas()
        roots = nodes[nodes["node"] == 0].set_index("tree")["size"]
        short = [t for t in trees if roots.get(t, 0) < psi] if p < 1.0 else []
        parts.append(nodes[~nodes["tree"].isin(short)])
        trees, p = short, min(1.0, p * 2.0)
    model = ForestModel(pd.concat(parts, ignore_index=True), list(features), psi, n_trees, max_depth,
                        contamination=contamination)
    scored = score_samples(df, model, key)
    if return_scores:
        from ..session import reliable_checkpoint
        scored = reliable_checkpoint(scored)
    model.offset = exact_quantile(scored, "score_samples", contamination, n)
    if return_scores:
        return model, scored
    return model


def score_samples(df: DataFrame, model: ForestModel, key: str = "physician_id") -> DataFrame:
    """M4 (raw): ``df`` plus ``score_samples`` = -2^(-E[h(x)] / c(psi)); lower is more abnormal."""
    spark: SparkSession = df.sparkSession
    arrays = model.arrays()
    nbytes = sum(a.nbytes for a in arrays)
    if nbytes > MAX_MODEL_BYTES:
        raise ValueError(f"forest of {nbytes} bytes is too large to broadcast; "
                         "lower max_samples (tree depth) or n_trees")
    bc = spark.sparkContext.broadcast(arrays)
    feats, n_trees, depth_cap = list(model.features), model.n_trees, model.max_depth
    norm = float(average_path_length([model.psi])[0]) or 1.0
    schema = T.StructType(df.schema.fields + [T.StructField("score_samples", T.DoubleType())])

    def score(batches):
        feat, split, left, right, size = bc.value
        for pdf in batches:
            X = pdf[feats].to_numpy(dtype=float)
            X = np.nan_to_num(X, nan=0.0)
            rows = np.arange(len(X))
            total = np.zeros(len(X))
            for t in range(n_trees):
                node = np.zeros(len(X), dtype=np.int64)
                depth = np.zeros(len(X))
                for _ in range(depth_cap + 1):
                    f = feat[t, node]
                    inner = f >= 0
                    if not inner.any():
                        break
                    go_left = X[rows, np.maximum(f, 0)] <= split[t, node]
                    node = np.where(inner, np.where(go_left, left[t, node], right[t, node]), node)
                    depth += inner
                total += depth + average_path_length(size[t, node])
            pdf = pdf.copy()
            pdf["score_samples"] = -np.power(2.0, -(total / n_trees) / norm)
            yield pdf

    return df.mapInPandas(score, schema)


def score_samples_native(df: DataFrame, model: ForestModel) -> DataFrame:
    """``score_samples`` in Spark's own functions: the trees are one constant of
    nested arrays (bounded like the broadcast one), walked by ``aggregate``.  No
    Python worker; meant for few rows or plans that must stay in the JVM, as the
    steps are interpreted while ``score_samples`` takes whole batches at a time."""
    feat, split, left, right, size = model.arrays()
    if sum(a.nbytes for a in (feat, split, left, right, size)) > MAX_MODEL_BYTES:
        raise ValueError("the forest is too large for a constant; lower max_samples or n_trees")
    length = average_path_length(size)
    trees = [[{"f": int(f), "s": float(s), "l": int(a), "r": int(b), "h": float(h)} for f, s, a, b, h in zip(*tree, strict=True)]
             for tree in zip(feat, split, left, right, length, strict=True)]
    forest = F.from_json(F.lit(json.dumps(trees)), "array<array<struct<f: int, s: double, l: int, r: int, h: double>>>")
    row = F.array(*[F.nanvl(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in model.features])
    steps = F.array(*[F.lit(i) for i in range(model.max_depth + 1)])

    def path(tree: Column) -> Column:
        """Depth of the leaf that the row reaches and the length that its size stands for."""
        start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("depth"))

        def step(now: Column, _: Column) -> Column:
            node = F.get(tree, now["at"])
            goes = F.when(F.get(F.col("_x"), node["f"]) <= node["s"], node["l"]).otherwise(node["r"])
            return F.when(node["f"] < 0, now).otherwise(F.struct(goes.alias("at"), (now["depth"] + 1).alias("depth")))

        return F.aggregate(steps, start, step, lambda end: end["depth"] + F.get(tree, end["at"])["h"])

    norm = float(average_path_length([model.psi])[0]) or 1.0
    total = F.aggregate(forest, F.lit(0.0), lambda acc, tree: acc + path(tree))
    return (df.withColumn("_x", row)
            .withColumn("score_samples", -F.pow(F.lit(2.0), -(total / model.n_trees) / F.lit(norm))).drop("_x"))


def predict(df: DataFrame, model: ForestModel, key: str = "physician_id", native: bool = False) -> DataFrame:
    """M4: ``anomaly_score`` = score_samples - offset, ``is_anomaly`` = score < 0."""
    s = score_samples_native(df, model) if native else score_samples(df, model, key)
    return (s.withColumn("anomaly_score", F.col("score_samples") - F.lit(model.offset))
             .withColumn("is_anomaly", F.col("anomaly_score") < 0).drop("score_samples"))


def nodes_frame(spark: SparkSession, model: ForestModel) -> DataFrame:
    return spark.createDataFrame(model.nodes, NODE_SCHEMA)


def save_model(spark: SparkSession, model: ForestModel, path: str, scaler: DataFrame | None = None) -> str:
    """Node table + parameters (+ scaler statistics) as parquet under ``path``."""
    nodes_frame(spark, model).write.mode("overwrite").parquet(f"{path}/nodes")
    params = spark.createDataFrame([(",".join(model.features), model.psi, model.n_trees, model.max_depth,
                                     model.offset, model.contamination)],
                                   "features string, psi int, n_trees int, max_depth int, offset double, "
                                   "contamination double")
    params.write.mode("overwrite").parquet(f"{path}/params")
    if scaler is not None:
        scaler.write.mode("overwrite").parquet(f"{path}/scaler")
    return path


def load_model(spark: SparkSession, path: str) -> tuple[ForestModel, DataFrame | None]:
    """Load a saved model; FileNotFoundError when it is absent."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/params")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        raise FileNotFoundError(f"no saved forest under {path}: train and save one before loading")
    prm = spark.read.parquet(f"{path}/params").first()
    nodes = spark.read.parquet(f"{path}/nodes").toPandas()
    model = ForestModel(nodes, prm["features"].split(","), prm["psi"], prm["n_trees"], prm["max_depth"],
                        prm["offset"], prm["contamination"])
    sp = jvm.org.apache.hadoop.fs.Path(f"{path}/scaler")
    scaler = spark.read.parquet(f"{path}/scaler") if fs.exists(sp) else None
    return model, scaler
