"""Data-quality checks from stored profiles of loads (Q1-Q6).

A profile holds, for one load and one check, what merges: row and value counts, the
mean and the squared deviations of numbers, and changes of the exact numbers of
distinct keys and of orphans.  The suite merges the profiles of all loads and judges
them as ``quality.run_checks`` judges the whole tables, so a new load costs one scan
of the load.  The means merge by the usual formula for parallel variances.

Distinct keys and orphans need the keys seen so far: ``plans/quality_run.py`` keeps
them in hash buckets and hands over what of a load is new.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import reliable_checkpoint
from .quality import CHECK_SCHEMA, Check, _judge, _judge_ri, _missing_row, default_suite

#: ``hits``: present values (Q1), new distinct keys (Q2), numbers (Q5), new distinct values
#: (Q3).  ``low`` and ``high``: numbers outside the bounds (Q5); ``low``: change of orphans (Q3).
PROFILE_SCHEMA = T.StructType([
    T.StructField("table", T.StringType()), T.StructField("measured", T.StringType()), T.StructField("found", T.BooleanType()),
    T.StructField("rows", T.LongType()), T.StructField("hits", T.LongType()), T.StructField("low", T.LongType()),
    T.StructField("high", T.LongType()), T.StructField("mean", T.DoubleType()), T.StructField("m2", T.DoubleType()),
])


def measured(c: Check) -> str:
    """What a profile entry holds: a check's name with all that its counts depend on
    (names alone repeat: two bounds or two parents of one column)."""
    return "|".join([c.name, *("" if v is None else str(v) for v in (c.min_val, c.max_val, c.parent_table, c.parent_column))])


def _loaded(table: str) -> str:
    """Name of the entry that says a table has had a load."""
    return f"loaded_{table}"


def _entry(c: Check, found: bool, rows: Column, hits=0, low=0, high=0, mean=None, m2=None) -> Column:
    values = {"table": F.lit(c.table), "measured": F.lit(measured(c)), "found": F.lit(found), "rows": rows, "hits": hits, "low": low,
              "high": high, "mean": mean, "m2": m2}
    typed = [(v if isinstance(v, Column) else F.lit(v)).cast(PROFILE_SCHEMA[k].dataType).alias(k) for k, v in values.items()]
    return F.struct(*typed)


def profile_load(rows: DataFrame, checks: Iterable[Check], table: str) -> DataFrame:
    """The profile of one load of ``table`` (``checks``: those of that table) for Q1,
    Q2, Q4 and Q5: one aggregation, combined on the map side.  Of Q2 only the row count;
    its keys come from ``entries``."""
    types = {f.name: f.dataType for f in rows.schema.fields}
    aggs, out = {"_total": F.count(F.lit(1))}, []
    for i, c in enumerate(checks):
        found = c.column is None or c.column in types
        total = F.col("_total")
        if c.check_type == "completeness" and found:
            present = F.col(c.column).isNotNull()
            if isinstance(types[c.column], (T.DoubleType, T.FloatType)):
                present = present & ~F.isnan(c.column)
            aggs[f"_c{i}"] = F.count_if(present)
            out.append(_entry(c, found, total, F.col(f"_c{i}")))
        elif c.check_type == "distribution" and found:
            v = F.col(c.column).cast("string").try_cast("double")
            v = F.when(~F.isnan(v), v)
            aggs[f"_n{i}"], aggs[f"_mean{i}"] = F.count(v), F.avg(v)
            aggs[f"_m2{i}"] = F.var_pop(v) * F.count(v)
            aggs[f"_lo{i}"] = F.count_if(v < F.lit(c.min_val)) if c.min_val is not None else F.lit(0).cast("long")
            aggs[f"_hi{i}"] = F.count_if(v > F.lit(c.max_val)) if c.max_val is not None else F.lit(0).cast("long")
            out.append(_entry(c, found, total, *(F.col(f"_{k}{i}") for k in ("n", "lo", "hi", "mean", "m2"))))
        else:
            out.append(_entry(c, found, total))
    mark = F.lit(_loaded(table))
    out.append(_entry(Check("row_count", table), True, F.col("_total")).withField("measured", mark))
    return rows.agg(*[e.alias(k) for k, e in aggs.items()]).select(F.inline(F.array(*out)))


def entries(spark, changes: list[tuple[Check, int, int]]) -> DataFrame:
    """Profile rows of new keys: (check, new distinct values, change of orphans)."""
    rows = [(c.table, measured(c), True, 0, hits, low, 0, None, None) for c, hits, low in changes]
    return spark.createDataFrame(rows, PROFILE_SCHEMA)


def merge(profiles: DataFrame) -> DataFrame:
    """One profile row for every check (also the way to fold many loads into one)."""
    mean = F.col("mean")
    parts = profiles.groupBy("table", "measured").agg(
        F.bool_or("found").alias("found"), F.sum("rows").alias("rows"), F.sum("hits").alias("hits"), F.sum("low").alias("low"),
        F.sum("high").alias("high"), F.collect_list(F.when(mean.isNotNull(), F.struct("hits", "mean", "m2"))).alias("_parts"))
    # two steps over at most one entry a load: the common mean, then deviations from it
    n = F.aggregate("_parts", F.lit(0.0), lambda a, p: a + p["hits"])
    with_mean = parts.withColumn("mean", F.aggregate("_parts", F.lit(0.0), lambda a, p: a + p["hits"] * p["mean"]) / F.nullif(n, F.lit(0.0)))
    m2 = F.aggregate("_parts", F.lit(0.0), lambda a, p: a + p["m2"] + p["hits"] * (p["mean"] - F.col("mean")) * (p["mean"] - F.col("mean")))
    return with_mean.withColumn("m2", F.when(F.col("mean").isNotNull(), m2)).select(*PROFILE_SCHEMA.names)


def run_checks(profiles: DataFrame, checks: Iterable[Check] | None = None) -> DataFrame:
    """Q6 from profiles: the rows that ``quality.run_checks`` gives over all loads together.
    A check without any profile gives a failing row that says so."""
    checks = list(checks) if checks is not None else default_suite()
    fields = [n for n in PROFILE_SCHEMA.names if n not in ("table", "measured")]
    one = F.map_from_entries(F.collect_list(F.struct("measured", F.struct(*fields))))
    merged = reliable_checkpoint(merge(profiles).groupBy().agg(one.alias("_all")))   # one row, read once a check
    out = None
    for c in checks:
        p = F.try_element_at("_all", F.lit(measured(c)))
        reason = F.when(p.isNull(), f"Table {c.table} not found").when(~p["found"], f"Column {c.column} not found in {c.table}")
        if c.check_type == "referential_integrity":
            parent = F.try_element_at("_all", F.lit(_loaded(c.parent_table)))
            reason = F.coalesce(reason, F.when(parent.isNull(), f"Table {c.parent_table} not found"))
        seen = merged.filter(reason.isNull())
        if c.check_type == "referential_integrity":
            rows = _judge_ri(seen.select(p["hits"].alias("_kids"), p["low"].alias("_orph")), c)
        else:
            std = F.sqrt(p["m2"] / F.nullif(p["hits"] - 1, F.lit(0)))
            rows = _judge(seen.select(
                p["rows"].alias("_total"), p["hits"].alias("_c0"), p["hits"].alias("_n0"), p["low"].alias("_lo0"),
                p["high"].alias("_hi0"), p["mean"].alias("_mean0"), std.alias("_std0")), [c], {c.column})
        absent = merged.filter(reason.isNotNull()).select(F.inline(F.array(_missing_row(c, reason))))
        rows = rows.unionByName(absent)
        out = rows if out is None else out.unionByName(rows)
    return out if out is not None else profiles.sparkSession.createDataFrame([], CHECK_SCHEMA)
