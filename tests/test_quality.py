"""Data-quality checks on the reference's 500-row fixture (FIXTURES.md A4)."""
import datetime as dt

from pyspark.sql import functions as F

from careflow.operators import quality as Q


def _tables(spark):
    pats = spark.range(100).select(F.format_string("PAT-%06d", "id").alias("patient_id"))
    rx = spark.range(500).select(
        F.format_string("RX-%07d", "id").alias("prescription_id"),
        F.when(F.col("id") % 20 == 0, F.lit(None)).otherwise(
            F.format_string("PAT-%06d", F.col("id") % 100)).alias("patient_id"),
        F.format_string("PHY-%d", F.col("id") % 20).alias("physician_id"),
        F.when(F.col("id") % 50 == 0, 999).otherwise(30).alias("quantity"),
        F.lit(dt.date(2023, 6, 15)).alias("prescription_date"), F.lit("DrugA").alias("drug_name"))
    return {"stg_prescriptions": rx, "stg_patients": pats}


def _one(spark, check):
    return Q.run_checks(_tables(spark), [check]).first()


def test_fixture_expectations(spark):
    c = _one(spark, Q.completeness("stg_prescriptions", "patient_id"))
    assert c.score == 0.95 and c.passed and c.details == "475/500 non-null (95.0%)"
    d = _one(spark, Q.distribution("stg_prescriptions", "quantity", 1, 500))
    assert d.score == 0.98 and d.passed and d.details.endswith("10 outliers")
    r = _one(spark, Q.referential_integrity("stg_prescriptions", "patient_id", "stg_patients", "patient_id"))
    assert r.score == 1.0 and r.details == "0 orphan values out of 95"
    assert _one(spark, Q.row_count("stg_prescriptions", 50)).passed
    assert not _one(spark, Q.row_count("stg_prescriptions", 1000)).passed
    u = _one(spark, Q.uniqueness("stg_prescriptions", "prescription_id"))
    assert u.passed and u.details == "500/500 unique (100.0%)"


def test_suite_equals_single_checks(spark):
    checks = [Q.completeness("stg_prescriptions", "patient_id"), Q.uniqueness("stg_patients", "patient_id"),
              Q.row_count("stg_patients", 100), Q.distribution("stg_prescriptions", "quantity", 1, 500),
              Q.referential_integrity("stg_prescriptions", "patient_id", "stg_patients", "patient_id")]
    together = {r.name: r for r in Q.run_checks(_tables(spark), checks).collect()}
    for c in checks:
        assert together[c.name] == _one(spark, c)


def test_empty_and_missing(spark):
    empty = spark.createDataFrame([], "patient_id string")
    rows = {r.name: r for r in Q.run_checks({"t": empty}, [Q.completeness("t", "patient_id"),
                                                            Q.uniqueness("t", "patient_id"),
                                                            Q.completeness("t", "nope"),
                                                            Q.row_count("absent", 1)]).collect()}
    assert rows["completeness_t_patient_id"].details == "Table is empty"
    assert rows["uniqueness_t_patient_id"].details == "" and rows["uniqueness_t_patient_id"].score == 0.0
    assert not rows["completeness_t_nope"].passed and "not found" in rows["completeness_t_nope"].details
    assert rows["row_count_absent"].details == "Table absent not found"
    kept = Q.run_checks({"t": empty}, [Q.completeness("t", "nope"), Q.row_count("absent", 1)], skip_missing=True)
    assert kept.count() == 0


def test_report_and_gate(spark):
    checks = Q.run_checks(_tables(spark), [Q.row_count("stg_prescriptions", 50),
                                           Q.row_count("stg_prescriptions", 1000)])
    rep = Q.dq_report(checks).first()
    assert (rep.total_checks, rep.passed, rep.failed_count, rep.overall_score) == (2, 1, 1, 0.5)
    assert [f.name for f in rep.failed_checks] == ["row_count_stg_prescriptions"]
    try:
        Q.enforce_gate(Q.dq_report(checks))
        raise AssertionError("gate should fail")
    except ValueError as e:
        assert "50%" in str(e)
