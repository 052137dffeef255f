"""KPI queries (SQL file, HTTP routes, dashboard) as DataFrame functions.

Scale notes
* Counts over a join with the patient dimension are pre-aggregated per
  patient on the fact side first (map-side partial aggregation), so a patient
  holding a third of all prescriptions becomes one row before any shuffle.
* "IN (subquery)" is a left semi join; the set side is made distinct by an
  aggregation, never collected.
* Top-k reports use ``orderBy(...).limit(k)`` (per-partition top-k, then a
  k-row merge); every output column is part of the order so ties are stable.
* A lookup of one patient filters to a literal key; the dimension side is at
  most one current row per patient (SCD-2 invariant), so it is broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import filter_at_least, filter_equal
from ..schemas import DROP_OFF_MAX_RX, REGIONS, THERAPY_AREAS


def _rate(num, den, scale: float, digits: int):
    return F.round(F.try_divide(num.cast("double"), F.nullif(den, F.lit(0)).cast("double")) * scale, digits)


# --------------------------------------------------------------------------- K
def switch_rate(therapy_switches: DataFrame, fact_prescription: DataFrame) -> DataFrame:
    """K1: distinct switching patients / distinct prescribed patients x 100 per
    therapy area (2 dp), highest first.  Areas without a switch are absent."""
    switched = (therapy_switches.groupBy("therapy_area")
                .agg(F.count_distinct("patient_id").alias("patients_switched")))
    treated = (fact_prescription.groupBy("therapy_area")
               .agg(F.count_distinct("patient_id").alias("_treated")))
    return (switched.join(treated, "therapy_area", "left")
            .select("therapy_area", "patients_switched",
                    _rate(F.col("patients_switched"), F.col("_treated"), 100.0, 2).alias("switch_rate"))
            .orderBy(F.col("switch_rate").desc_nulls_last(), "therapy_area"))


def _rx_per_patient_area(fact_prescription: DataFrame) -> DataFrame:
    return fact_prescription.groupBy("patient_id", "therapy_area").agg(F.count(F.lit(1)).alias("rx_count"))


def drop_off_by_therapy(fact_prescription: DataFrame, max_rx: int = DROP_OFF_MAX_RX) -> DataFrame:
    """K2: per therapy area, patient x area pairs with at most ``max_rx``
    prescriptions: count and percentage (2 dp)."""
    t = _rx_per_patient_area(fact_prescription)
    drop = F.sum(F.when(F.col("rx_count") <= max_rx, 1).otherwise(0)).cast("long")
    return (t.groupBy("therapy_area")
            .agg(F.count(F.lit(1)).alias("total"), drop.alias("dropoffs"))
            .withColumn("dropoff_pct", _rate(F.col("dropoffs"), F.col("total"), 100.0, 2)))


def monthly_physician_volume(fact_prescription: DataFrame) -> DataFrame:
    """K3: prescriptions and mean quantity per physician and month."""
    return (fact_prescription
            .groupBy("physician_id", F.date_format("prescription_date", "yyyy-MM").alias("month"))
            .agg(F.count(F.lit(1)).alias("rx_count"), F.avg("quantity").alias("avg_qty"))
            .orderBy("physician_id", "month"))


def anomalies_by_region(anomaly_results: DataFrame, dim_physician: DataFrame) -> DataFrame:
    """K4: flagged physicians and mean confidence per physician region."""
    phys = dim_physician.select("physician_id", "region")
    return (anomaly_results.select("physician_id", "confidence").join(phys, "physician_id")
            .groupBy("region")
            .agg(F.count(F.lit(1)).alias("flagged_physicians"),
                 F.avg(F.col("confidence").cast("double")).alias("avg_confidence")))


# --------------------------------------------------------------------------- A
def patient_journey_lookup(fact_patient_journey: DataFrame, dim_patient: DataFrame, patient_id) -> DataFrame:
    """One patient's journey by sequence, with current demographics
    and the event count.  An unknown patient gives no rows (not found)."""
    j = fact_patient_journey.filter(F.col("patient_id") == F.lit(patient_id))
    total = j.select(F.count(F.lit(1))).scalar()
    demo = (dim_patient.filter((F.col("patient_id") == F.lit(patient_id)) & (F.col("is_current") == 1))
            .select("patient_id", "gender", "date_of_birth", "region", "enrollment_date"))
    return (j.join(F.broadcast(demo), "patient_id", "left")
            .withColumn("total_events", total)
            .orderBy("sequence_num"))


def _limit(limit: int, most: int) -> int:
    """A list's limit; one outside 1 .. ``most`` is an error, never silently changed."""
    if not 1 <= int(limit) <= most:
        raise ValueError(f"limit must be between 1 and {most}")
    return int(limit)


def list_patients(dim_patient: DataFrame, region: str | None = None, limit: int = 50) -> DataFrame:
    """A2: current patients, optional region, first ``limit`` (1 to 500) by patient id."""
    limit = _limit(limit, 500)
    df = dim_patient.filter(F.col("is_current") == 1)
    if region:
        df = df.filter(F.col("region") == F.lit(region))
    return df.orderBy("patient_id").limit(limit)


ANOMALY_ORDER = ["anomaly_score", "physician_id", "anomaly_type", "total_prescriptions", "avg_quantity",
                 "max_quantity", "unique_patients", "detection_date", "confidence", "explanation"]


def list_anomalies(anomaly_results: DataFrame, date=None, min_confidence: float = 0.0,
                   limit: int = 50) -> DataFrame:
    """A3: anomalies, optional detection date and minimum confidence (applied
    only when > 0), lowest score first, first ``limit`` (1 to 500)."""
    limit = _limit(limit, 500)
    df = anomaly_results
    if date:
        df = df.filter(F.col("detection_date") == F.lit(str(date)).cast("date"))
    df = filter_at_least(df, "confidence", min_confidence)
    return df.orderBy(*ANOMALY_ORDER).limit(limit)


def physician_anomaly(anomaly_results: DataFrame, physician_id) -> DataFrame:
    """A4: one row: is the physician flagged, and its first (lowest-score) detail row."""
    rows = anomaly_results.filter(F.col("physician_id") == F.lit(physician_id))
    detail_cols = [c for c in anomaly_results.columns if c != "physician_id"]
    first = F.min_by(F.struct(*detail_cols), F.struct(*[F.col(c) for c in ANOMALY_ORDER]))
    return (rows.agg(F.count(F.lit(1)).alias("_n"), first.alias("_d"))
            .select(F.lit(physician_id).alias("physician_id"),
                    (F.col("_n") > 0).alias("is_anomalous"),
                    *[F.col("_d").getField(c).alias(c) for c in detail_cols]))


def anomaly_summary(anomaly_results: DataFrame) -> DataFrame:
    """A5 (1/3): total anomalies and mean confidence (3 dp)."""
    return anomaly_results.agg(
        F.count(F.lit(1)).alias("total_anomalies"),
        F.round(F.avg(F.col("confidence").cast("double")), 3).alias("avg_confidence"))


def anomaly_count_by_type(anomaly_results: DataFrame) -> DataFrame:
    """A5 (2/3): anomalies per type."""
    return anomaly_results.groupBy("anomaly_type").agg(F.count(F.lit(1)).alias("n"))


def top_anomalies(anomaly_results: DataFrame, k: int = 5) -> DataFrame:
    """A5 (3/3): the ``k`` lowest scores."""
    return (anomaly_results.orderBy(*ANOMALY_ORDER).limit(k)
            .select("physician_id", "anomaly_score", "explanation"))


SWITCH_ORDER = ["switch_date", "patient_id", "from_drug", "to_drug", "therapy_area"]


def list_switches(therapy_switches: DataFrame, therapy_area: str | None = None, limit: int = 100) -> DataFrame:
    """A6 (list): switches, optional area, first ``limit`` (1 to 1000) in a stated order."""
    limit = _limit(limit, 1000)
    return filter_equal(therapy_switches, therapy_area=therapy_area or None).orderBy(*SWITCH_ORDER).limit(limit)


def switch_summary(therapy_switches: DataFrame, therapy_area: str | None = None) -> DataFrame:
    """A6 (summary) over all switches of the area: total and distinct patients."""
    return filter_equal(therapy_switches, therapy_area=therapy_area or None).agg(
        F.count(F.lit(1)).alias("total_switches"), F.count_distinct("patient_id").alias("unique_patients"))


def switch_top(therapy_switches: DataFrame, column: str, therapy_area: str | None = None, k: int = 5) -> DataFrame:
    """A6 (top from / to drugs) over all switches of the area: most frequent values, ties by value."""
    return (filter_equal(therapy_switches, therapy_area=therapy_area or None).groupBy(F.col(column).alias("drug")).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col("drug").asc_nulls_last()).limit(k))


def global_totals(dim_patient: DataFrame, fact_prescription: DataFrame, therapy_switches: DataFrame,
                  anomaly_results: DataFrame) -> DataFrame:
    """Current patients, prescriptions, switches and anomalies as one row
    (four uncorrelated scalar subqueries, no join)."""
    spark = dim_patient.sparkSession

    def count_of(df):
        return df.select(F.count(F.lit(1))).scalar()

    return spark.range(1).select(
        count_of(dim_patient.filter(F.col("is_current") == 1)).alias("total_patients"),
        count_of(fact_prescription).alias("total_prescriptions"),
        count_of(therapy_switches).alias("total_therapy_switches"),
        count_of(anomaly_results).alias("total_anomalies_detected"))


def prescriptions_by_therapy(fact_prescription: DataFrame) -> DataFrame:
    """Prescriptions per therapy area."""
    return fact_prescription.groupBy("therapy_area").agg(F.count(F.lit(1)).alias("vol"))


def overall_drop_off(fact_prescription: DataFrame, therapy_area: str | None = None,
                     max_rx: int = DROP_OFF_MAX_RX) -> DataFrame:
    """Drop-off over patient x therapy pairs (optional area); rate 4 dp; no pairs -> 0."""
    df = fact_prescription
    if therapy_area:
        df = df.filter(F.col("therapy_area") == F.lit(therapy_area))
    t = _rx_per_patient_area(df)
    return (t.agg(F.count(F.lit(1)).alias("pairs_analyzed"),
                  F.count_if(F.col("rx_count") <= max_rx).alias("drop_off_count"))
            .withColumn("drop_off_rate", F.coalesce(
                _rate(F.col("drop_off_count"), F.col("pairs_analyzed"), 1.0, 4), F.lit(0.0))))


# --------------------------------------------------------------------------- D
@dataclass(frozen=True)
class DashboardFilter:
    """Region / therapy selection.  'All' or a value outside the allowed set
    is ignored (as the dashboard does)."""
    region: str = "All"
    therapy: str = "All"
    valid_regions: tuple = tuple(REGIONS)
    valid_therapies: tuple = tuple(THERAPY_AREAS)

    @property
    def region_value(self):
        return self.region if self.region != "All" and self.region in self.valid_regions else None

    @property
    def therapy_value(self):
        return self.therapy if self.therapy != "All" and self.therapy in self.valid_therapies else None


def filter_values(dim_patient: DataFrame, fact_prescription: DataFrame) -> DataFrame:
    """Distinct regions and therapy areas, sorted (kind, value)."""
    regions = dim_patient.select(F.lit("region").alias("kind"), F.col("region").alias("value")).distinct()
    areas = fact_prescription.select(F.lit("therapy").alias("kind"),
                                     F.col("therapy_area").alias("value")).distinct()
    return regions.unionByName(areas).orderBy("kind", "value")


def _patients(dim_patient: DataFrame, f: DashboardFilter) -> DataFrame:
    """Current patients under the region filter (one current row per patient;
    used as the right side of semi joins, so no distinct is needed)."""
    df = dim_patient.filter(F.col("is_current") == 1)
    if f.region_value is not None:
        df = df.filter(F.col("region") == F.lit(f.region_value))
    return df.select("patient_id")


def _rx(fact_prescription: DataFrame, f: DashboardFilter) -> DataFrame:
    if f.therapy_value is not None:
        return fact_prescription.filter(F.col("therapy_area") == F.lit(f.therapy_value))
    return fact_prescription


def _per_patient(df: DataFrame, *keys: str) -> DataFrame:
    """Pre-aggregate rows to one count per (patient, keys) before the join."""
    return df.groupBy("patient_id", *keys).agg(F.count(F.lit(1)).alias("_n"))


def _filtered_rx_counts(fact_prescription, dim_patient, f, *keys):
    counts = _per_patient(_rx(fact_prescription, f), *keys)
    return counts.join(_patients(dim_patient, f), "patient_id", "left_semi")


def _filtered_rx_patients(fact_prescription, dim_patient, f):
    """Distinct patients of prescriptions under the filters (IN-subquery set)."""
    rx_pat = _rx(fact_prescription, f).select("patient_id").distinct()
    return rx_pat.join(_patients(dim_patient, f), "patient_id", "left_semi")


def patient_card(dim_patient, fact_prescription, f: DashboardFilter = DashboardFilter()) -> DataFrame:
    """Distinct current patients (left join prescriptions under the filters)."""
    pats = _patients(dim_patient, f)
    if f.therapy_value is not None:
        # the therapy predicate on the right side of the left join keeps only matched patients
        pats = pats.join(_rx(fact_prescription, f).select("patient_id"), "patient_id", "left_semi")
    return pats.agg(F.count_distinct("patient_id").alias("cnt"))


def rx_card(fact_prescription, dim_patient, f: DashboardFilter = DashboardFilter()) -> DataFrame:
    """D3: prescriptions of filtered patients."""
    c = _filtered_rx_counts(fact_prescription, dim_patient, f)
    return c.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("cnt"))


def switch_card(therapy_switches, fact_prescription, dim_patient, f: DashboardFilter = DashboardFilter()) -> DataFrame:
    """Switches whose patient is among the filtered prescription patients."""
    sw = therapy_switches
    if f.therapy_value is not None:
        sw = sw.filter(F.col("therapy_area") == F.lit(f.therapy_value))
    c = _per_patient(sw).join(_filtered_rx_patients(fact_prescription, dim_patient, f), "patient_id", "left_semi")
    return c.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("cnt"))


def _filtered_physicians(fact_prescription, dim_patient, f):
    pairs = _rx(fact_prescription, f).select("patient_id", "physician_id").distinct()
    return (pairs.join(_patients(dim_patient, f), "patient_id", "left_semi")
            .select("physician_id").distinct())


def anomaly_card(anomaly_results, fact_prescription, dim_patient, f: DashboardFilter = DashboardFilter()) -> DataFrame:
    """Distinct flagged physicians among the filtered prescription physicians."""
    a = anomaly_results.join(_filtered_physicians(fact_prescription, dim_patient, f), "physician_id", "left_semi")
    return a.agg(F.count_distinct("physician_id").alias("cnt"))


def rx_volume_by_therapy(fact_prescription, dim_patient, f: DashboardFilter = DashboardFilter()) -> DataFrame:
    """Prescription volume per therapy area under the filters."""
    c = _filtered_rx_counts(fact_prescription, dim_patient, f, "therapy_area")
    return c.groupBy("therapy_area").agg(F.sum("_n").cast("long").alias("volume"))


def top_switch_pairs(therapy_switches, fact_prescription, dim_patient,
                     f: DashboardFilter = DashboardFilter(), k: int = 10) -> DataFrame:
    """The ``k`` most frequent (from, to) switch pairs under the filters."""
    sw = therapy_switches
    if f.therapy_value is not None:
        sw = sw.filter(F.col("therapy_area") == F.lit(f.therapy_value))
    c = (_per_patient(sw, "from_drug", "to_drug")
         .join(_filtered_rx_patients(fact_prescription, dim_patient, f), "patient_id", "left_semi"))
    return (c.groupBy("from_drug", "to_drug").agg(F.sum("_n").cast("long").alias("count"))
            .orderBy(F.col("count").desc(), F.col("from_drug").asc_nulls_last(),
                     F.col("to_drug").asc_nulls_last())
            .limit(k))


def top_anomalies_filtered(anomaly_results, fact_prescription, dim_patient,
                           f: DashboardFilter = DashboardFilter(), k: int = 10) -> DataFrame:
    """The ``k`` lowest-score distinct anomaly rows of filtered physicians."""
    cols = ["physician_id", "anomaly_score", "confidence", "explanation"]
    a = (anomaly_results.join(_filtered_physicians(fact_prescription, dim_patient, f), "physician_id", "left_semi")
         .select(*cols).distinct())
    return a.orderBy("anomaly_score", "physician_id", "confidence", "explanation").limit(k)


def daily_rx_volume(fact_prescription, dim_patient, f: DashboardFilter = DashboardFilter()) -> DataFrame:
    """Prescriptions per day under the filters, by date."""
    c = _filtered_rx_counts(fact_prescription, dim_patient, f, "prescription_date")
    return (c.groupBy("prescription_date").agg(F.sum("_n").cast("long").alias("volume"))
            .orderBy("prescription_date"))
