"""Warehouse transforms on the reference's small fixtures (FIXTURES.md A1, A2)."""
import datetime as dt

from pyspark.sql import functions as F

from careflow.functions.cleaning import normalize_dates, to_int_or_zero
from careflow.operators import warehouse as W

RX = [
    ("RX-0000001", "PAT-000001", "PHY-00001", "DrugA-Onc", "2023-01-15", 30, 2, "Oncology"),
    ("RX-0000002", "PAT-000001", "PHY-00001", "DrugB-Onc", "2023-03-20", 60, 1, "Oncology"),
    ("RX-0000003", "PAT-000002", "PHY-00002", "DrugA-Card", "2023-02-10", 90, 3, "Cardiology"),
    ("RX-0000004", "PAT-000003", "PHY-00001", "DrugA-Onc", "2023-04-01", 700, 0, "Oncology"),
]
RX_SCHEMA = ("prescription_id string, patient_id string, physician_id string, drug_name string, "
             "prescription_date string, quantity int, refills int, therapy_area string")


def test_exactly_one_switch(spark):
    fact = W.transform_prescriptions(spark.createDataFrame(RX, RX_SCHEMA), order=[])
    sw = W.detect_therapy_switches(fact).collect()
    assert len(sw) == 1
    r = sw[0]
    assert (r.patient_id, r.from_drug, r.to_drug, r.switch_date, r.therapy_area) == (
        "PAT-000001", "DrugA-Onc", "DrugB-Onc", dt.date(2023, 3, 20), "Oncology")


def test_switches_do_not_depend_on_input_order(spark):
    fwd = W.detect_therapy_switches(W.transform_prescriptions(spark.createDataFrame(RX, RX_SCHEMA), order=[]))
    rev = W.detect_therapy_switches(W.transform_prescriptions(spark.createDataFrame(RX[::-1], RX_SCHEMA), order=[]))
    assert sorted(fwd.collect()) == sorted(rev.collect())


def test_null_drug_counts_as_a_switch(spark):
    rows = [("1", "P", "X", "A", "2023-01-01", 1, 0, "T"), ("2", "P", "X", None, "2023-01-02", 1, 0, "T"),
            ("3", "P", "X", None, "2023-01-03", 1, 0, "T")]
    fact = W.transform_prescriptions(spark.createDataFrame(rows, RX_SCHEMA), order=[])
    sw = W.detect_therapy_switches(fact).collect()
    assert [(r.from_drug, r.to_drug) for r in sw] == [("A", None)]


def test_keep_last_dedup_fixture(spark):
    df = spark.createDataFrame([("A", 1, 1), ("B", 2, 2), ("A", 3, 3), ("C", 4, 4)], "id string, value int, seq int")
    out = W.dedup_keep_last(df, "id", ["seq"]).collect()
    assert len(out) == 3
    assert {r.id: r.value for r in out}["A"] == 3


def test_normalize_dates_drops_bad(spark):
    df = spark.createDataFrame([("2023-01-15",), ("not-a-date",), ("2023-03-10",)], "d string")
    out = normalize_dates(df, ["d", "absent"]).collect()
    assert [r.d for r in out] == [dt.date(2023, 1, 15), dt.date(2023, 3, 10)]


def test_to_int_or_zero(spark):
    df = spark.createDataFrame([("3.7",), ("x",), (None,), ("inf",), ("-2.9",)], "q string")
    assert [r.q for r in to_int_or_zero(df, ["q"]).collect()] == [3, 0, 0, 0, -2]


def test_journey_invariants(spark):
    fact = W.transform_prescriptions(spark.createDataFrame(RX, RX_SCHEMA), order=[])
    dx = spark.createDataFrame([("DX-1", "PAT-000001", "C34.1", dt.date(2023, 3, 20)),
                                ("DX-2", "PAT-000002", "I25.1", dt.date(2022, 1, 1)),
                                ("DX-3", None, "G20", dt.date(2022, 1, 1))],
                               "diagnosis_id string, patient_id string, icd_code string, diagnosis_date date")
    j = W.build_patient_journey(fact, dx).toPandas()
    assert len(j) == 4 + 3
    for pid, g in j[j.patient_id.notna()].groupby("patient_id"):
        assert sorted(g.sequence_num) == list(range(1, len(g) + 1))
    p1 = j[j.patient_id == "PAT-000001"].sort_values("sequence_num")
    # same day: prescription before diagnosis
    assert list(p1.event_type) == ["prescription", "prescription", "diagnosis"]
    assert j[j.patient_id.isna()].sequence_num.isna().all()
    # without a diagnosis table the journey is the prescriptions only
    assert W.build_patient_journey(fact, None).count() == 4


def test_dim_therapy_and_patients(spark):
    fact = W.transform_prescriptions(spark.createDataFrame(RX, RX_SCHEMA), order=[])
    assert [(r.therapy_area, r.drug_count) for r in W.transform_therapy(fact).collect()] == [
        ("Oncology", 2), ("Cardiology", 1)]
    pats = spark.createDataFrame([("PAT-1", "M", "1980-01-01", "North", "2020-01-01", dt.datetime(2024, 1, 1)),
                                  ("PAT-1", "F", "1980-01-01", "South", "2020-01-01", dt.datetime(2024, 2, 1)),
                                  ("PAT-2", "F", "bad", "East", "2020-01-01", dt.datetime(2024, 1, 1))],
                                 "patient_id string, gender string, date_of_birth string, region string, "
                                 "enrollment_date string, ingested_at timestamp")
    dim = W.transform_patients(pats, "2025-01-01").collect()
    assert len(dim) == 1 and dim[0].region == "South" and dim[0].is_current == 1
    assert dim[0].effective_to == dt.date(9999, 12, 31)
    assert "ingested_at" not in W.transform_patients(pats, "2025-01-01").columns


def test_dim_physician_years_and_keep_last(spark):
    rows = [("PHY-1", "Onc", "North", "12.9", dt.datetime(2024, 1, 1)),
            ("PHY-1", "Card", "South", "x", dt.datetime(2024, 2, 1)),
            ("PHY-2", "Neuro", "East", None, dt.datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "physician_id string, specialty string, region string, "
                                     "years_experience string, ingested_at timestamp")
    out = {r.physician_id: (r.specialty, r.years_experience) for r in W.transform_physicians(df).collect()}
    assert out == {"PHY-1": ("Card", 0), "PHY-2": ("Neuro", 0)}
    df2 = df.filter("specialty = 'Onc'")
    assert W.transform_physicians(df2).first().years_experience == 12


def test_strict_dates_are_those_of_the_pattern_and_skip_its_parser(spark):
    from careflow.functions.cleaning import to_date_strict
    texts = ["2023-01-15", "2024-02-29", "2023-02-29", "2023-13-01", "2023-00-10", "2023-1-5", "2023-01-5", "2023", "2023-01",
             " 2023-01-15", "2023-01-15 ", "2023-01-15\n", "2023-01-15T00:00:00", "2023-01-15 10:00:00", "20230115", "0000-01-01",
             "0001-01-01", "9999-12-31", "10000-01-01", "+10000-01-01", "+2023-01-15", "-2023-01-15", "02023-01-15", "x2023-01-15",
             "2023/01/15", "not-a-date", "", None, "1582-10-10", "\u0662\u0660\u0662\u0663-01-15", "2023-01-15Z", "2023-06-31"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = df.select("t", F.try_to_date("t", "yyyy-MM-dd").cast("string").alias("by_pattern"), to_date_strict(F.col("t")).cast("string").alias("strict"))
    assert [r for r in out.collect() if r["by_pattern"] != r["strict"]] == []
    plan = df.select(to_date_strict(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" in plan
