"""Data-quality checks (Q1-Q9).

Every check of one table is evaluated inside **one** aggregation over that
table (one scan, partial aggregation on the map side); the per-check rows
are then unpacked from the one-row result with ``inline``.  Referential
integrity needs the parent table and is a distinct + left-anti join.

A check row: name, check_type, table, column, threshold, passed, score,
details -- the fields of the reference's check object.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cleaning import ts_literal
from ..schemas import DQ_GATE

CHECK_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("check_type", T.StringType()),
    T.StructField("table", T.StringType()), T.StructField("column", T.StringType()),
    T.StructField("threshold", T.DoubleType()), T.StructField("passed", T.BooleanType()),
    T.StructField("score", T.DoubleType()), T.StructField("details", T.StringType()),
])


@dataclass(frozen=True)
class Check:
    check_type: str                 # completeness | uniqueness | row_count | distribution | referential_integrity
    table: str
    column: str | None = None
    threshold: float = 0.95
    min_rows: int = 1
    min_val: float | None = None
    max_val: float | None = None
    parent_table: str | None = None
    parent_column: str | None = None
    approx: bool = False            # uniqueness by HyperLogLog++ instead of an exact distinct count

    @property
    def name(self) -> str:
        prefix = {"referential_integrity": "ref_integrity"}.get(self.check_type, self.check_type)
        if self.check_type == "row_count":
            return f"row_count_{self.table}"
        return f"{prefix}_{self.table}_{self.column}"


def completeness(table, column, threshold=0.95) -> Check:
    return Check("completeness", table, column, threshold)


def uniqueness(table, column, threshold=0.99, approx=False) -> Check:
    return Check("uniqueness", table, column, threshold, approx=approx)


def row_count(table, min_rows=1) -> Check:
    return Check("row_count", table, None, 1.0, min_rows=min_rows)


def distribution(table, column, min_val=None, max_val=None) -> Check:
    return Check("distribution", table, column, 0.95, min_val=min_val, max_val=max_val)


def referential_integrity(child_table, child_col, parent_table, parent_col) -> Check:
    return Check("referential_integrity", child_table, child_col, 0.95,
                 parent_table=parent_table, parent_column=parent_col)


# The reference's suite (16 checks).
def default_suite() -> list[Check]:
    return [
        completeness("stg_prescriptions", "patient_id"),
        completeness("stg_prescriptions", "physician_id"),
        completeness("stg_prescriptions", "drug_name"),
        completeness("stg_diagnoses", "patient_id"),
        completeness("stg_diagnoses", "icd_code"),
        completeness("stg_claims", "patient_id"),
        completeness("stg_claims", "amount"),
        uniqueness("stg_prescriptions", "prescription_id"),
        uniqueness("stg_diagnoses", "diagnosis_id"),
        uniqueness("stg_claims", "claim_id"),
        uniqueness("stg_patients", "patient_id"),
        row_count("stg_patients", 100),
        row_count("stg_physicians", 50),
        row_count("stg_prescriptions", 1000),
        distribution("stg_prescriptions", "quantity", min_val=1, max_val=500),
        referential_integrity("stg_prescriptions", "patient_id", "stg_patients", "patient_id"),
    ]


def _pct(score: Column) -> Column:
    """Python's '{:.1%}' of a score (half-to-even at one decimal)."""
    return F.format_string("%.1f%%", F.bround(score * 100.0, 1))


def _fmt1(x: Column) -> Column:
    """Python's '{:.1f}', with 'nan' for a missing value."""
    return F.when(x.isNull() | F.isnan(x), F.lit("nan")).otherwise(F.format_string("%.1f", F.bround(x, 1)))


def _row(c: Check, passed: Column, score: Column, details: Column) -> Column:
    return F.struct(F.lit(c.name).alias("name"), F.lit(c.check_type).alias("check_type"),
                    F.lit(c.table).alias("table"), F.lit(c.column).cast("string").alias("column"),
                    F.lit(float(c.threshold)).alias("threshold"), passed.alias("passed"),
                    score.cast("double").alias("score"), details.alias("details"))


def _missing_row(c: Check, reason: str | Column) -> Column:
    return _row(c, F.lit(False), F.lit(0.0), reason if isinstance(reason, Column) else F.lit(reason))


def _table_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All single-table checks of one table -> check rows.

    One aggregate, combined on the map side, gives all counts; a uniqueness
    check counts its key column alone in a subquery, so only keys are shuffled."""
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs: dict[str, Column] = {"_total": F.count(F.lit(1))}
    unique: dict[int, Column] = {}
    for i, c in enumerate(checks):
        if c.column is not None and c.column not in types:
            continue
        col = F.col(c.column) if c.column else None
        if c.check_type == "completeness":
            present = col.isNotNull()
            if isinstance(types[c.column], (T.DoubleType, T.FloatType)):
                present = present & ~F.isnan(col)
            aggs[f"_c{i}"] = F.count_if(present)
        elif c.check_type == "uniqueness":
            if c.approx:
                aggs[f"_c{i}"] = F.approx_count_distinct(col)
            else:
                unique[i] = df.select(F.count_distinct(col)).scalar()
        elif c.check_type == "distribution":
            v = col.cast("string").try_cast("double")
            v = F.when(~F.isnan(v), v)
            aggs[f"_n{i}"] = F.count(v)
            aggs[f"_lo{i}"] = F.count_if(v < F.lit(c.min_val)) if c.min_val is not None else F.lit(0).cast("long")
            aggs[f"_hi{i}"] = F.count_if(v > F.lit(c.max_val)) if c.max_val is not None else F.lit(0).cast("long")
            aggs[f"_mean{i}"] = F.avg(v)
            aggs[f"_std{i}"] = F.stddev_samp(v)
    one = df.agg(*[e.alias(k) for k, e in aggs.items()])
    one = one.withColumns({f"_c{i}": e for i, e in unique.items()}) if unique else one
    return _judge(one, checks, set(types))


def _judge(one: DataFrame, checks: list[Check], columns: set[str]) -> DataFrame:
    """Check rows of one table from one row of counts: ``_total``, and by the check's
    place ``_c`` (present or distinct), ``_n`` / ``_lo`` / ``_hi`` / ``_mean`` / ``_std``."""
    total = F.col("_total")
    rows = []
    for i, c in enumerate(checks):
        if c.column is not None and c.column not in columns:
            rows.append(_missing_row(c, f"Column {c.column} not found in {c.table}"))
            continue
        if c.check_type == "completeness":
            score = F.try_divide(F.col(f"_c{i}").cast("double"), total.cast("double"))
            rows.append(F.when(total == 0, _row(c, F.lit(False), F.lit(0.0), F.lit("Table is empty")))
                        .otherwise(_row(c, score >= c.threshold, score, F.format_string(
                            "%d/%d non-null (%s)", F.col(f"_c{i}"), total, _pct(score)))))
        elif c.check_type == "uniqueness":
            score = F.try_divide(F.col(f"_c{i}").cast("double"), total.cast("double"))
            rows.append(F.when(total == 0, _row(c, F.lit(False), F.lit(0.0), F.lit("")))
                        .otherwise(_row(c, score >= c.threshold, score, F.format_string(
                            "%d/%d unique (%s)", F.col(f"_c{i}"), total, _pct(score)))))
        elif c.check_type == "row_count":
            ok = total >= c.min_rows
            rows.append(_row(c, ok, F.when(ok, 1.0).otherwise(0.0),
                             F.format_string(f"%d rows (need at least {c.min_rows})", total)))
        elif c.check_type == "distribution":
            n = F.col(f"_n{i}")
            out = F.col(f"_lo{i}") + F.col(f"_hi{i}")
            score = F.lit(1.0) - F.try_divide(out.cast("double"), n.cast("double"))
            details = F.format_string("mean=%s, std=%s, %d outliers",
                                      _fmt1(F.col(f"_mean{i}")), _fmt1(F.col(f"_std{i}")), out)
            rows.append(F.when(n == 0, _row(c, F.lit(False), F.lit(0.0), F.lit("No numeric values")))
                        .otherwise(_row(c, score >= c.threshold, score, details)))
    return one.select(F.inline(F.array(*rows)))


def _ri_check(child: DataFrame, parent: DataFrame, c: Check) -> DataFrame:
    """Q3: 1 - orphans / distinct child values (nulls dropped); no values -> 1."""
    kids = child.select(F.col(c.column).alias("_v")).filter(F.col("_v").isNotNull()).distinct()
    parents = (parent.select(F.col(c.parent_column).alias("_v")).filter(F.col("_v").isNotNull()).distinct()
               .withColumn("_found", F.lit(True)))
    # one pass: distinct child values left-joined to distinct parent values
    counted = (kids.join(parents, "_v", "left")
               .agg(F.count(F.lit(1)).alias("_kids"), F.count_if(F.col("_found").isNull()).alias("_orph")))
    return _judge_ri(counted, c)


def _judge_ri(counted: DataFrame, c: Check) -> DataFrame:
    """The check row from one row of ``_kids`` (distinct values) and ``_orph`` (those without a parent)."""
    n_kids, n_orph = F.col("_kids"), F.col("_orph")
    score = F.when(n_kids > 0, F.lit(1.0) - n_orph.cast("double") / n_kids.cast("double")).otherwise(F.lit(1.0))
    return counted.select(F.inline(F.array(_row(
        c, score >= c.threshold, score,
        F.format_string("%d orphan values out of %d", n_orph, n_kids)))))


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check] | None = None,
               skip_missing: bool = False) -> DataFrame:
    """Q6: run ``checks`` (default: the 16-check suite) against named tables.

    A missing table or column gives a failing row whose details say why;
    ``skip_missing=True`` drops such rows instead (the reference's behaviour).
    """
    checks = list(checks) if checks is not None else default_suite()
    spark = (next(iter(tables.values())).sparkSession if tables else None) or SparkSession.getActiveSession()
    parts: list[DataFrame] = []
    by_table: dict[str, list[Check]] = {}
    for c in checks:
        if c.check_type == "referential_integrity":
            missing = [t for t in (c.table, c.parent_table) if t not in tables]
            if not missing:
                cols_missing = [(t, col) for t, col in ((c.table, c.column), (c.parent_table, c.parent_column))
                                if col not in tables[t].columns]
                if not cols_missing:
                    parts.append(_ri_check(tables[c.table], tables[c.parent_table], c))
                    continue
                reason = f"Column {cols_missing[0][1]} not found in {cols_missing[0][0]}"
            else:
                reason = f"Table {missing[0]} not found"
            if not skip_missing:
                parts.append(spark.range(1).select(F.inline(F.array(_missing_row(c, reason)))))
            continue
        by_table.setdefault(c.table, []).append(c)
    for table, cs in by_table.items():
        if table not in tables:
            if not skip_missing:
                parts.append(spark.range(1).select(F.inline(F.array(
                    *[_missing_row(c, f"Table {table} not found") for c in cs]))))
            continue
        df = _table_checks(tables[table], cs)
        if skip_missing:
            df = df.filter(~F.col("details").startswith("Column "))
        parts.append(df)
    if not parts:
        return spark.createDataFrame([], CHECK_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dq_report(check_rows: DataFrame, timestamp=None) -> DataFrame:
    """Q7: one row: total, passed, failed count, overall score (0 without
    checks) and the failed checks as an array of structs (sorted by name)."""
    ts = F.localtimestamp() if timestamp is None else ts_literal(timestamp)
    failed = F.filter(F.collect_list(F.struct(*[F.col(c) for c in CHECK_SCHEMA.names])),
                      lambda s: ~s.getField("passed"))
    return check_rows.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("passed")).alias("passed"),
        F.count_if(~F.col("passed")).alias("failed_count"),
        F.coalesce(F.try_divide(F.count_if(F.col("passed")).cast("double"),
                                F.count(F.lit(1)).cast("double")), F.lit(0.0)).alias("overall_score"),
        F.array_sort(failed, lambda a, b: F.when(a.getField("name") < b.getField("name"), -1)
                     .when(a.getField("name") > b.getField("name"), 1).otherwise(0)).alias("failed_checks"),
    ).withColumn("timestamp", ts)


def gate(report: DataFrame, threshold: float = DQ_GATE) -> DataFrame:
    """Q8 (as data): the report's overall score and whether it clears the gate."""
    return report.select("overall_score", (F.col("overall_score") >= threshold).alias("gate_passed"))


def enforce_gate(report: DataFrame, threshold: float = DQ_GATE) -> float:
    """Q8 (job step): raise when the overall score is below the gate.
    One ``first()`` on the one-row report."""
    score = report.select("overall_score").first()[0]
    if score < threshold:
        raise ValueError(f"DQ score below threshold: {score:.0%}")
    return score


def dq_trend(dq_scores: DataFrame, n: int = 10) -> DataFrame:
    """Q9: the last ``n`` scores, newest first."""
    return (dq_scores.select("run_timestamp", "overall_score")
            .orderBy(F.col("run_timestamp").desc(), F.col("overall_score").desc()).limit(n))
