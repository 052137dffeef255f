"""Warehouse transforms: staging tables -> dimensions, facts, journey, switches.

Every function maps DataFrames to a DataFrame; nothing is collected.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cleaning import drop_if_present, normalize_dates, to_int_or_zero, with_constants
from ..functions.ordering import HOT_ROWS, _day_key, _hot_groups, keep_last, previous_value, sequence_number
from ..schemas import HIGH_DATE
from ..session import dealt_checkpoint, reliable_checkpoint

# Default arrival order of staging rows: batch stamp, file, then position in file.
# These are helper columns; the dimensions drop them.
ARRIVAL_ORDER = ("ingested_at", "_file", "_row_number")


def _order(df: DataFrame, order: Sequence[str] | None) -> list[str]:
    if order is not None:
        return list(order)
    return [c for c in ARRIVAL_ORDER if c in df.columns]


def dedup_keep_last(df: DataFrame, key: str, order: Sequence[str] | None = None, placed: bool = False) -> DataFrame:
    """V9: one row per key, the last one in arrival order (``order``; default
    ingested_at, then file, then row number).  Remaining columns break ties, so the
    result does not depend on partitioning.  ``placed`` as in ``keep_last``."""
    return keep_last(df, key, _order(df, order), placed)


def transform_patients(stg_patients: DataFrame, as_of: _dt.date | str,
                       order: Sequence[str] | None = None) -> DataFrame:
    """T1 dim_patient: keep-last per patient, parse dates (drop bad), SCD-2 columns."""
    df = dedup_keep_last(stg_patients, "patient_id", order)
    df = normalize_dates(df, ["date_of_birth", "enrollment_date"])
    df = with_constants(df, {
        "effective_from": F.lit(str(as_of)).cast("date"),
        "effective_to": F.lit(HIGH_DATE).cast("date"),
        "is_current": F.lit(1).cast("smallint"),
    })
    return drop_if_present(df, *ARRIVAL_ORDER)


def transform_physicians(stg_physicians: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """T2 dim_physician: keep-last per physician, years_experience -> int (bad -> 0)."""
    df = dedup_keep_last(stg_physicians, "physician_id", order)
    df = to_int_or_zero(df, ["years_experience"])
    return drop_if_present(df, *ARRIVAL_ORDER)


FACT_COLUMNS = ["prescription_id", "patient_id", "physician_id", "drug_name", "prescription_date",
                "quantity", "refills", "therapy_area"]


def transform_prescriptions(stg_prescriptions: DataFrame, order: Sequence[str] | None = None, placed: bool = False) -> DataFrame:
    """T3 fact_prescription: keep-last per prescription, parse date (drop bad),
    quantity / refills -> int (bad -> 0).  ``placed`` as in ``keep_last``."""
    df = dedup_keep_last(stg_prescriptions, "prescription_id", order, placed)
    df = normalize_dates(df, ["prescription_date"])
    df = to_int_or_zero(df, ["quantity", "refills"])
    return df.select(*FACT_COLUMNS)


def transform_therapy(fact_prescription: DataFrame) -> DataFrame:
    """T4 dim_therapy: distinct drugs per therapy area, most first."""
    return (fact_prescription.groupBy("therapy_area")
            .agg(F.count_distinct("drug_name").alias("drug_count"))
            .orderBy(F.col("drug_count").desc(), F.col("therapy_area")))


JOURNEY_COLUMNS = ["patient_id", "event_type", "event_date", "event_detail", "therapy_area", "sequence_num"]


def _events(fact_prescription: DataFrame, stg_diagnoses: DataFrame | None, *more: str) -> DataFrame:
    """Prescriptions (with the columns ``more``) and diagnoses as rows of one shape."""
    rx = fact_prescription.select(
        "patient_id", F.lit("prescription").alias("event_type"),
        F.col("prescription_date").alias("event_date"), F.col("drug_name").alias("event_detail"),
        "therapy_area", F.col("prescription_id").cast("string").alias("_source_id"), *more)
    if stg_diagnoses is None:
        return rx
    dx = stg_diagnoses.select(
        "patient_id", F.lit("diagnosis").alias("event_type"),
        F.col("diagnosis_date").cast("date").alias("event_date"),
        F.col("icd_code").alias("event_detail"), F.lit("").alias("therapy_area"),
        F.col("diagnosis_id").cast("string").alias("_source_id"))
    return rx.unionByName(dx, allowMissingColumns=True)


def build_patient_journey(fact_prescription: DataFrame, stg_diagnoses: DataFrame | None,
                          hot_rows: int = HOT_ROWS) -> DataFrame:
    """T5 fact_patient_journey: prescriptions and diagnoses of a patient in one
    ordered sequence.  Order: event date (nulls last), prescriptions before
    diagnoses on the same day, then the source id.  Without a diagnosis table
    the journey holds prescriptions only."""
    events = _events(fact_prescription, stg_diagnoses)
    seq = sequence_number(events, "patient_id", "event_date",
                          [F.col("event_type").desc(), F.col("_source_id")], hot_rows=hot_rows)
    return seq.select(*JOURNEY_COLUMNS)


def detect_therapy_switches(fact_prescription: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """T6 therapy_switches: consecutive prescriptions of a patient (by date,
    then prescription id) whose drug differs (null-safe).  The switch carries
    the new prescription's date and therapy area.  Rows without patient are
    ignored."""
    rx = fact_prescription.select("patient_id", "drug_name", "prescription_date",
                                  "therapy_area", "prescription_id")
    prev = previous_value(rx, "patient_id", "prescription_date", ["prescription_id"],
                          "drug_name", out="from_drug", has_out="_has_prev", hot_rows=hot_rows)
    return (prev.filter(F.col("_has_prev") & ~F.col("drug_name").eqNullSafe(F.col("from_drug")))
                .select("patient_id", "from_drug", F.col("drug_name").alias("to_drug"),
                        F.col("prescription_date").alias("switch_date"), "therapy_area"))


def journeys_and_switches(fact_prescription: DataFrame, stg_diagnoses: DataFrame | None,
                          hot_rows: int = HOT_ROWS, buckets: int = 0) -> tuple[DataFrame, DataFrame]:
    """T5 and T6 of the same patients from one shuffle: the rows of ``build_patient_journey``
    and of ``detect_therapy_switches``.  Events are numbered and given the drug before
    them by windows that lie in the same tasks (of one sort, where ids are text), and
    written once; journeys and switches are read from that table.  Patients of very many events take the other two
    functions, which cut them into slices.  ``buckets``: events are dealt out by patient
    to so many files, in place of a shuffle (``dealt_checkpoint``)."""
    # an id of text orders the prescriptions of a day as it orders their events
    raw = fact_prescription.schema["prescription_id"].dataType.simpleString() != "string"
    events = _events(fact_prescription, stg_diagnoses, *(["prescription_id"] if raw else []))
    if buckets > 1:
        events = dealt_checkpoint(events, "patient_id", buckets)
    known = events.filter(F.col("patient_id").isNotNull())
    is_rx = F.col("event_type") == "prescription"
    hot, n_hot = _hot_groups(known, "patient_id", hot_rows)
    # a column, not an expression in the windows, which would sort for each of them
    of_all = Window.partitionBy("patient_id").orderBy("_day", F.col("event_type").desc(), "_source_id")
    steps = known.join(hot.select("patient_id"), "patient_id", "left_anti") if n_hot else known
    steps = steps.withColumn("_day", _day_key("event_date")).withColumn("sequence_num", F.row_number().over(of_all).cast("int"))
    if raw:
        of_kind = Window.partitionBy("patient_id", "event_type").orderBy("_day", "prescription_id")
        steps = (steps.withColumn("from_drug", F.lag("event_detail").over(of_kind))
                 .withColumn("_later", F.row_number().over(of_kind) > 1))
    else:    # the last prescription before the event, in the order that the rows are in
        drug = F.last(F.when(is_rx, F.struct("event_detail")), ignorenulls=True)
        steps = (steps.withColumn("_before", drug.over(of_all.rowsBetween(Window.unboundedPreceding, -1)))
                 .withColumn("from_drug", F.col("_before.event_detail")).withColumn("_later", F.col("_before").isNotNull()))
    steps = reliable_checkpoint(steps.select(*JOURNEY_COLUMNS, "from_drug", "_later"))
    nobody = events.filter(F.col("patient_id").isNull()).withColumn("sequence_num", F.lit(None).cast("int"))
    journeys = steps.select(*JOURNEY_COLUMNS).unionByName(nobody.select(*JOURNEY_COLUMNS))
    switched = is_rx & F.col("_later") & ~F.col("event_detail").eqNullSafe(F.col("from_drug"))
    switches = steps.filter(switched).select(
        "patient_id", "from_drug", F.col("event_detail").alias("to_drug"), F.col("event_date").alias("switch_date"), "therapy_area")
    if n_hot:
        facts, diagnoses = (None if df is None else df.join(hot.select("patient_id"), "patient_id", "left_semi")
                            for df in (fact_prescription, stg_diagnoses))
        journeys = journeys.unionByName(build_patient_journey(facts, diagnoses, hot_rows))
        switches = switches.unionByName(detect_therapy_switches(facts, hot_rows))
    return journeys, switches
