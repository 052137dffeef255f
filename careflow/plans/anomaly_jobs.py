"""Training (M9) and inference (M7) jobs around the isolation forest."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import anomaly, forest
from ..session import drop_checkpoint, reliable_checkpoint
from ..sources.tables import TableStore

KEY = "physician_id"


def train(fact_prescription: DataFrame, n_trees: int = 100, contamination: float = 0.05,
          seed: int = 42, max_samples: int = 256):
    """M1 -> M2 fit -> M3.  Returns (model, scaler stats, features).

    The feature table (one row per physician) is read by several passes
    (count, sampling, offset, scoring), so it is checkpointed once to the
    shared checkpoint folder: lineage is cut and a lost executor does not
    send the passes back to the fact table."""
    feats = reliable_checkpoint(anomaly.physician_features(fact_prescription))
    stats = anomaly.scaling_stats(feats)
    scaled = anomaly.standard_scale(feats, stats)
    model = forest.fit(scaled, anomaly.FEATURE_COLS, KEY, n_trees=n_trees, max_samples=max_samples,
                       contamination=contamination, seed=seed)
    return model, stats, feats


def train_and_score(fact_prescription: DataFrame, n_trees: int = 100, contamination: float = 0.05,
                    seed: int = 42, max_samples: int = 256):
    """M1 -> M2 -> M3 -> M4 -> M5 in one pass over the features: the training
    scores that set the offset are the scores of the same physicians, so
    they are reused instead of scoring twice.  Returns (model, stats, scored)."""
    feats = reliable_checkpoint(anomaly.physician_features(fact_prescription))
    stats = anomaly.scaling_stats(feats)
    scaled = anomaly.standard_scale(feats, stats)
    model, raw = forest.fit(scaled, anomaly.FEATURE_COLS, KEY, n_trees=n_trees, max_samples=max_samples,
                            contamination=contamination, seed=seed, return_scores=True)
    pred = raw.select(KEY, (F.col("score_samples") - F.lit(model.offset)).alias("anomaly_score"))
    pred = pred.withColumn("is_anomaly", F.col("anomaly_score") < 0)
    return model, stats, anomaly.with_confidence(feats.join(pred, KEY))


def score(feats: DataFrame, model: forest.ForestModel, stats: DataFrame) -> DataFrame:
    """M2 (stored stats) -> M4 -> M5 on M1 features: every physician with
    features, anomaly_score, is_anomaly and confidence."""
    scaled = anomaly.standard_scale(feats, stats)
    pred = forest.predict(scaled, model, KEY).select(KEY, "anomaly_score", "is_anomaly")
    return anomaly.with_confidence(feats.join(pred, KEY))


def train_and_save(spark: SparkSession, store: TableStore, model_path: str, **kw) -> dict:
    """M9: features -> forest -> save (S15) -> daily z-score; returns counts."""
    fact = store.read("fact_prescription")
    model, stats, feats = train(fact, **kw)
    forest.save_model(spark, model, model_path, stats)
    z = anomaly.daily_zscore(fact)
    return {"model_path": model_path, "physicians_analyzed": feats.count(),
            "zscore_anomaly_days": z.filter("is_anomaly").count()}


def run_inference(spark: SparkSession, store: TableStore, model_path: str,
                  detection_date: _dt.date | None = None, limits: dict | None = None) -> dict:
    """M7: load the model, score, keep the flagged physicians, replace anomaly_results."""
    model, stats = forest.load_model(spark, model_path)
    detection_date = detection_date or _dt.datetime.now(_dt.timezone.utc).date()
    feats = reliable_checkpoint(anomaly.physician_features(store.read("fact_prescription")))
    scored = reliable_checkpoint(score(feats, model, stats))
    try:
        results = anomaly.anomaly_results(scored, detection_date, limits)
        store.replace(results, "anomaly_results")
        return {"total_scored": scored.count(),
                "anomalies_detected": store.read("anomaly_results").count()}
    finally:
        drop_checkpoint(scored)
        drop_checkpoint(feats)
