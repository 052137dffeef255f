"""Registered queries that score physicians with a saved forest of fixed nodes: the
SQL walks the same nodes by itself, so S15 and M4 have an independent check."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import functions as F

from ..operators import anomaly, forest
from ..session import scratch_path
from .registry import register

# --- fixed values: nodes (tree, node, feature, split, left, right, size, depth) of three small trees ---
NODES = [
    (0, 0, 0, 450.0, 1, 2, 64, 0), (0, 1, 1, 25.2, 3, 4, 40, 1), (0, 2, -1, 0.0, -1, -1, 24, 1),
    (0, 3, -1, 0.0, -1, -1, 30, 2), (0, 4, 3, 400.0, 5, 6, 10, 2), (0, 5, -1, 0.0, -1, -1, 9, 3), (0, 6, -1, 0.0, -1, -1, 1, 3),
    (1, 0, 1, 25.0, 1, 2, 64, 0), (1, 1, 0, 440.0, 3, 4, 2, 1), (1, 2, -1, 0.0, -1, -1, 62, 1),
    (1, 3, -1, 0.0, -1, -1, 1, 2), (1, 4, -1, 0.0, -1, -1, 1, 2),
    (2, 0, 3, 415.0, 1, 2, 64, 0), (2, 1, -1, 0.0, -1, -1, 33, 1), (2, 2, 2, 49.0, 3, 4, 31, 1),
    (2, 3, -1, 0.0, -1, -1, 2, 2), (2, 4, -1, 0.0, -1, -1, 29, 2)]
PSI, DEPTH, OFFSET = 64, 3, -0.43
# --- end of fixed values ---

_C = "CASE WHEN {0} <= 1 THEN 0.0 WHEN {0} = 2 THEN 1.0 ELSE 2.0 * (ln({0} - 1.0) + 0.5772156649) - 2.0 * ({0} - 1.0) / {0} END"
_VALUE = " ".join(f"WHEN {i} THEN CAST({c} AS DOUBLE)" for i, c in enumerate(anomaly.FEATURE_COLS))
_SQL = f"""
  SELECT physician_id, ROUND(raw - ({OFFSET}), 6) AS anomaly_score, raw - ({OFFSET}) < 0 AS is_anomaly FROM (
    SELECT physician_id, -pow(2.0, -avg(depth + {_C.format("size")}) / ({_C.format(float(PSI))})) AS raw
    FROM (
      WITH RECURSIVE nodes(tree, node, feature, split, l, r, size, d) AS (VALUES {", ".join(map(str, NODES))}),
      walk AS (
        SELECT physician_id, tree, 0 AS node, 0 AS depth FROM features, (SELECT DISTINCT tree FROM nodes)
        UNION ALL
        SELECT w.physician_id, w.tree, CASE WHEN CASE n.feature {_VALUE} END <= n.split THEN n.l ELSE n.r END, w.depth + 1
        FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node JOIN features f ON f.physician_id IS NOT DISTINCT FROM w.physician_id
        WHERE n.feature >= 0)
      SELECT w.physician_id, w.tree, w.depth, n.size FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node
      WHERE n.feature < 0)
    GROUP BY physician_id)"""


def _scored(t, native: bool):
    """Features of all physicians, scored by the forest that was saved and loaded again."""
    nodes = pd.DataFrame(NODES, columns=forest.NODE_SCHEMA.names)
    model = forest.ForestModel(nodes, list(anomaly.FEATURE_COLS), PSI, 3, DEPTH, offset=OFFSET)
    path = scratch_path(t.spark, f"careflow-forest-{uuid.uuid4().hex[:12]}")
    forest.save_model(t.spark, model, path)
    loaded, _ = forest.load_model(t.spark, path)
    found = forest.predict(t.features, loaded, native=native)
    return found.select("physician_id", F.round("anomaly_score", 6).alias("anomaly_score"), "is_anomaly")


@register("m4_saved_forest_scores", _SQL, ("features",))
def _m4_saved(t):
    return _scored(t, native=False)


@register("m4_saved_forest_scores_native", _SQL, ("features",))
def _m4_native(t):
    return _scored(t, native=True)
