"""Anomaly detection on physicians and on daily prescription volume.

M1 features, M2 scaling, M5 confidence, M6 explanation text, M7 result
table and M8 rolling z-score are built-in expressions.  The isolation
forest itself (M3 fit, M4 score) lives in ``forest.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import EXPLANATION_LIMITS, ZSCORE_LIMIT, ZSCORE_WINDOW

# --- fixed values: feature names ---
FEATURE_COLS = ["total_prescriptions", "avg_quantity", "max_quantity", "unique_patients", "unique_drugs"]


def physician_features(fact_prescription: DataFrame) -> DataFrame:
    """M1: per physician: prescriptions, mean / max quantity, distinct patients and drugs.

    Rows shrink to (physician, patient) and to (physician, drug), each combined on
    the map side, so no row is multiplied for the two distinct counts and a
    physician with very many rows is spread over many tasks."""
    by_patient = (fact_prescription.groupBy("physician_id", "patient_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("quantity").alias("n_quantity"),
        F.sum(F.col("quantity").cast("double")).alias("sum_quantity"), F.max("quantity").alias("max_quantity"))
        .groupBy("physician_id").agg(
            F.sum("n").alias("n"), F.sum("n_quantity").alias("n_quantity"), F.sum("sum_quantity").alias("sum_quantity"),
            F.max("max_quantity").alias("max_quantity"), F.count("patient_id").alias("unique_patients")))
    by_drug = (fact_prescription.select(F.col("physician_id").alias("_p"), "drug_name").distinct()
               .groupBy("_p").agg(F.count("drug_name").alias("unique_drugs")))
    return (by_patient.join(by_drug, F.col("physician_id").eqNullSafe(F.col("_p")))
            .select("physician_id", F.col("n").alias("total_prescriptions"),
                    F.try_divide("sum_quantity", "n_quantity").alias("avg_quantity"), "max_quantity",
                    "unique_patients", "unique_drugs"))


def scaling_stats(features: DataFrame, cols=FEATURE_COLS) -> DataFrame:
    """M2 fit: one row with mean and population std of each feature (nulls as 0).
    A zero std scales by 1, as the usual standard scaler does."""
    aggs = []
    for c in cols:
        v = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        aggs += [F.avg(v).alias(f"{c}__mean"), F.stddev_pop(v).alias(f"{c}__std")]
    return features.agg(*aggs)


def standard_scale(features: DataFrame, stats: DataFrame | None = None, cols=FEATURE_COLS,
                   key: str = "physician_id") -> DataFrame:
    """M2: fill nulls with 0 and standard-scale every feature column.

    ``stats`` (from ``scaling_stats``) is a one-row frame of 2 x features
    numbers; it enters as scalar subqueries, so nothing runs before the result
    is asked for and the feature table is not joined."""
    stats = stats if stats is not None else scaling_stats(features, cols)
    out = [F.col(key)]
    for c in cols:
        mean = F.coalesce(stats.select(f"{c}__mean").scalar(), F.lit(0.0))
        std = F.coalesce(F.nullif(stats.select(f"{c}__std").scalar(), F.lit(0.0)), F.lit(1.0))
        v = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        out.append(((v - mean) / std).alias(c))
    return features.select(*out)


def with_confidence(scored: DataFrame, score: str = "anomaly_score", out: str = "confidence") -> DataFrame:
    """M5: abs(score) / max abs(score) over all scored rows; 0 when that max is 0."""
    top = scored.select(F.max(F.abs(F.col(score)))).scalar()
    return scored.withColumn(out, F.coalesce(
        F.try_divide(F.abs(F.col(score)), F.nullif(top, F.lit(0.0))), F.lit(0.0)))


def explanation(limits: dict | None = None) -> Column:
    """M6: reasons for a flag joined by '; ', or a default sentence.
    Mean quantity is rounded half-to-even to a whole number."""
    lim = dict(EXPLANATION_LIMITS)
    lim.update(limits or {})
    reasons = [
        F.when(F.col("total_prescriptions") > lim["total_prescriptions"],
               F.format_string("High prescription volume (%d)", F.col("total_prescriptions").cast("long"))),
        F.when(F.col("avg_quantity") > lim["avg_quantity"],
               F.format_string("High avg quantity (%d)", F.bround(F.col("avg_quantity"), 0).cast("long"))),
        F.when(F.col("max_quantity") > lim["max_quantity"],
               F.format_string("Very high max quantity (%d)", F.col("max_quantity").cast("long"))),
        F.when(F.col("unique_patients") > lim["unique_patients"],
               F.format_string("Unusually many patients (%d)", F.col("unique_patients").cast("long"))),
    ]
    text = F.concat_ws("; ", *reasons)
    return F.when(text == "", F.lit("Statistical outlier in prescribing pattern")).otherwise(text)


# --- fixed values: result columns ---
RESULT_COLUMNS = ["physician_id", "anomaly_score", "anomaly_type", "total_prescriptions", "avg_quantity",
                  "max_quantity", "unique_patients", "detection_date", "confidence", "explanation"]


def anomaly_results(scored: DataFrame, detection_date, limits: dict | None = None,
                    anomaly_type: str = "prescription_volume") -> DataFrame:
    """M7 output: flagged rows only, with type, date, explanation, typed as the table.

    ``scored`` holds the M1 features plus anomaly_score, is_anomaly and
    confidence (confidence computed over all scored rows, before the filter)."""
    return (scored.filter(F.col("is_anomaly"))
            .withColumn("explanation", explanation(limits))
            .select(
                "physician_id",
                F.col("anomaly_score").cast("double").alias("anomaly_score"),
                F.lit(anomaly_type).alias("anomaly_type"),
                F.col("total_prescriptions").cast("int").alias("total_prescriptions"),
                F.col("avg_quantity").cast("decimal(10,2)").alias("avg_quantity"),
                F.col("max_quantity").cast("int").alias("max_quantity"),
                F.col("unique_patients").cast("int").alias("unique_patients"),
                F.lit(str(detection_date)).cast("date").alias("detection_date"),
                F.col("confidence").cast("decimal(5,4)").alias("confidence"),
                "explanation"))


def daily_zscore(fact_prescription: DataFrame, window: int = ZSCORE_WINDOW,
                 limit: float = ZSCORE_LIMIT) -> DataFrame:
    """M8: daily volume, trailing ``window``-row mean and sample std (null std
    -> 1), z-score, and flag abs(z) > limit.  Missing days are not filled.

    The rolling window has no partition key, so it runs in one task; its
    input is one row per calendar day (bounded by the calendar, not by data)."""
    daily = fact_prescription.groupBy("prescription_date").agg(F.count(F.lit(1)).alias("daily_volume"))
    w = Window.orderBy("prescription_date").rowsBetween(-(window - 1), 0)
    v = F.col("daily_volume").cast("double")
    df = (daily.withColumn("rolling_mean", F.avg(v).over(w))
               .withColumn("rolling_std", F.coalesce(F.stddev_samp(v).over(w), F.lit(1.0))))
    z = F.try_divide(v - F.col("rolling_mean"), F.col("rolling_std"))
    return (df.withColumn("z_score", z)
              .withColumn("is_anomaly", F.coalesce(F.abs(z) > F.lit(limit), F.lit(False)))
              .orderBy("prescription_date"))
