"""Record validation and the CSV source (FIXTURES.md A3, SURVEY §8-5..8)."""
import os

from careflow.operators import validate as V
from careflow.sources.csv import read_raw_csv

PAT_COLS = "patient_id string, gender string, date_of_birth string, region string, enrollment_date string"


def test_gender_enum(spark):
    df = spark.createDataFrame([("PAT-1", "M", "1980-01-01", "North", "2020-01-01"),
                                ("PAT-2", "X", "1980-01-01", "North", "2020-01-01")], PAT_COLS)
    out = {r.patient_id: r._validation_error for r in V.validate(df, "patients", corrupt=None).collect()}
    assert out["PAT-1"] is None
    assert out["PAT-2"] == "'X' is not one of ['M', 'F', 'Other']"


def test_rules(spark):
    cols = ("prescription_id string, patient_id string, physician_id string, drug_name string, "
            "prescription_date string, quantity string, refills string, therapy_area string")
    rows = [("1", "P", "D", "A", "2023-01-01", "3.7", "0", "T"),      # 3.7 -> 3: valid
            ("2", "P", "D", "A", "2023-99-99", "1", "0", "T"),        # pattern is shape only: valid
            ("3", "P", "D", "None", "2023-01-01", "1", "0", "T"),     # 'None' -> null
            ("4", "P", "D", "A", "01/02/2023", "1", "0", "T"),
            ("5", "P", "D", "A", "2023-01-01", "0", "0", "T"),
            ("6", "P", "D", "A", "2023-01-01", "inf", "0", "T"),
            ("7", "P", "D", "A", "2023-01-01", "1", "", "T")]         # optional but null -> invalid
    out = {r.prescription_id: r._validation_error
           for r in V.validate(spark.createDataFrame(rows, cols), "prescriptions", corrupt=None).collect()}
    assert out["1"] is None and out["2"] is None
    assert out["3"] == "None is not of type 'string'"
    assert out["4"] == "'01/02/2023' does not match '^\\d{4}-\\d{2}-\\d{2}$'"
    assert out["5"] == "0 is less than the minimum of 1"
    assert out["6"] == "'inf' is not of type 'integer'"
    assert out["7"] == "None is not of type 'integer'"
    valid, invalid = V.split(V.validate(spark.createDataFrame(rows, cols), "prescriptions", corrupt=None),
                             "prescriptions")
    assert valid.count() + invalid.count() == len(rows)
    q = {r.prescription_id: r.quantity for r in valid.collect()}
    assert q["1"] == 3


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_csv_one_valid_one_invalid_and_row_numbers(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "patients.csv")
    _write(p, "patient_id,gender,date_of_birth,region,enrollment_date\n"
              "PAT-1,M,1980-01-01,North,2020-01-01\nPAT-2,INVALID,1980-01-01,North,2020-01-01\n")
    checked = V.validate(read_raw_csv(spark, p), "patients")
    valid, invalid = V.split(checked, "patients")
    assert valid.count() == 1
    bad = invalid.collect()
    assert len(bad) == 1 and bad[0]._row_number == 2


def test_short_and_long_lines_are_quarantined(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "physicians.csv")
    _write(p, "physician_id,specialty,region,years_experience\n"
              "PHY-1,Oncologist,North,5\nPHY-2,Oncologist\nPHY-3,Oncologist,North,5,extra\n")
    checked = V.validate(read_raw_csv(spark, p), "physicians").cache()
    valid, invalid = V.split(checked, "physicians")
    assert [r.physician_id for r in valid.collect()] == ["PHY-1"]
    assert sorted(r._row_number for r in invalid.collect()) == [2, 3]


def test_missing_required_column(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "physicians.csv")
    _write(p, "physician_id,region,years_experience\nPHY-1,North,5\n")
    err = V.validate(read_raw_csv(spark, p), "physicians").first()._validation_error
    assert "'specialty' is a required property" in err


def test_row_numbers_across_many_blocks(spark, tmpdir_path):
    # small split size -> each file is read as several blocks by several tasks
    d = os.path.join(tmpdir_path, "many")
    os.makedirs(d)
    for f in range(3):
        lines = ["physician_id,specialty,region,years_experience"]
        lines += [f"F{f}-{i:06d},S,R,{i}" for i in range(1, 5001)]
        _write(os.path.join(d, f"part{f}.csv"), "\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = read_raw_csv(spark, d)
        assert df.rdd.getNumPartitions() > 3
        rows = df.select("physician_id", "years_experience", "_row_number").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 15000
    assert all(int(r.years_experience) == r._row_number for r in rows)


def test_row_numbers_with_a_shuffle_join(spark, tmpdir_path):
    # where the block offsets are not broadcast the numbers stay exact
    import careflow.sources.csv as C
    p = os.path.join(tmpdir_path, "one.csv")
    lines = ["physician_id,specialty,region,years_experience"] + [f"P{i},S,R,{i}" for i in range(1, 3001)]
    _write(p, "\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    old_bc = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = C.read_raw_csv(spark, p).select("years_experience", "_row_number").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old_bc)
    assert len(rows) == 3000 and all(int(r.years_experience) == r._row_number for r in rows)
