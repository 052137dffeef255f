"""Synthetic raw datasets (S1-S4) generated on the executors.

Row ``i`` of a dataset is a pure function of (seed, dataset, column, i):
every random pick is ``pmod(xxhash64(seed, tag, id), k)``.  So a dataset of
any size is a ``spark.range`` plus column expressions, and a dirty copy of
row ``i`` (S2) is produced by evaluating the same expressions at ``i``
again -- no join, no sample collected anywhere.
All columns are text, as in a CSV file.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import (CLAIM_STATUSES, DEFAULT_SIZES, DIRTY_SHARE, DRUGS, GENDERS, ICD_CODES, PAYERS,
                       RAW_COLUMNS, REGIONS, SEVERITIES, SPECIALTIES, THERAPY_AREAS)
from .csv import write_csv


def _h(seed: int, tag: str, idc: Column) -> Column:
    return F.xxhash64(F.lit(seed), F.lit(tag), idc)


def _randint(seed, tag, idc, lo: int, hi: int) -> Column:
    """Uniform integer in [lo, hi]."""
    return (F.pmod(_h(seed, tag, idc), F.lit(hi - lo + 1)) + F.lit(lo)).cast("int")


def _choice(seed, tag, idc, values) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, _randint(seed, tag, idc, 1, len(values)))


def _uniform(seed, tag, idc, lo: float, hi: float) -> Column:
    u = F.pmod(_h(seed, tag, idc), F.lit(1 << 53)).cast("double") / float(1 << 53)
    return F.lit(lo) + u * F.lit(hi - lo)


def _date_between(seed, tag, idc, as_of: str, days_back_lo: int, days_back_hi: int) -> Column:
    back = _randint(seed, tag, idc, days_back_lo, days_back_hi)
    return F.date_format(F.date_sub(F.lit(as_of).cast("date"), back), "yyyy-MM-dd")


def _ident(prefix: str, width: int, n: Column) -> Column:
    return F.format_string(f"{prefix}-%0{width}d", n.cast("long"))


def _rows(dataset: str, idc: Column, seed: int, as_of: str, sizes: dict) -> list[Column]:
    """Column expressions of row ``idc`` of ``dataset`` (all text)."""
    n_pat, n_phy = sizes["patients"], sizes["physicians"]
    patient = _ident("PAT", 6, _randint(seed, f"{dataset}.patient", idc, 1, n_pat))
    physician = _ident("PHY", 5, _randint(seed, f"{dataset}.physician", idc, 1, n_phy))
    if dataset == "patients":
        return [_ident("PAT", 6, idc + 1), _choice(seed, "p.gender", idc, GENDERS),
                _date_between(seed, "p.dob", idc, as_of, 18 * 365, 85 * 365),
                _choice(seed, "p.region", idc, REGIONS),
                _date_between(seed, "p.enrol", idc, as_of, 365, 5 * 365)]
    if dataset == "physicians":
        return [_ident("PHY", 5, idc + 1), _choice(seed, "d.specialty", idc, SPECIALTIES),
                _choice(seed, "d.region", idc, REGIONS),
                _randint(seed, "d.years", idc, 1, 35).cast("string")]
    if dataset == "prescriptions":
        therapy = _choice(seed, "rx.therapy", idc, THERAPY_AREAS)
        drug_map = F.create_map(*[x for a in THERAPY_AREAS for x in (F.lit(a), F.array(*map(F.lit, DRUGS[a])))])
        drugs = F.element_at(drug_map, therapy)
        drug = F.element_at(drugs, (F.pmod(_h(seed, "rx.drug", idc), F.size(drugs)) + 1).cast("int"))
        # every 500th prescription is a large outlier
        qty = F.when(F.pmod(idc, F.lit(500)) == 0, _randint(seed, "rx.qty_hi", idc, 500, 1000)) \
               .otherwise(_randint(seed, "rx.qty", idc, 1, 90))
        return [_ident("RX", 7, idc + 1), patient, physician, drug,
                _date_between(seed, "rx.date", idc, as_of, 0, 2 * 365), qty.cast("string"),
                _randint(seed, "rx.refills", idc, 0, 5).cast("string"), therapy]
    if dataset == "diagnoses":
        return [_ident("DX", 7, idc + 1), patient, _choice(seed, "dx.icd", idc, ICD_CODES),
                _date_between(seed, "dx.date", idc, as_of, 0, 3 * 365), physician,
                _choice(seed, "dx.severity", idc, SEVERITIES)]
    if dataset == "claims":
        amount = F.format_string("%.2f", F.round(_uniform(seed, "cl.amount", idc, 50.0, 15000.0), 2))
        return [_ident("CLM", 7, idc + 1), patient, _date_between(seed, "cl.date", idc, as_of, 0, 2 * 365),
                amount, _choice(seed, "cl.status", idc, CLAIM_STATUSES), _choice(seed, "cl.payer", idc, PAYERS)]
    raise ValueError(f"Unknown dataset type: {dataset}")


def generate(spark: SparkSession, dataset: str, n: int, seed: int = 42, as_of: str | None = None,
             sizes: dict | None = None) -> DataFrame:
    """``n`` clean rows of ``dataset``; foreign keys drawn from the parent sizes."""
    as_of = as_of or _dt.date.today().isoformat()
    sizes = {**DEFAULT_SIZES, **(sizes or {})}
    cols = RAW_COLUMNS[dataset]
    exprs = _rows(dataset, F.col("id"), seed, as_of, sizes)
    return spark.range(n).select(*[e.alias(c) for e, c in zip(exprs, cols)])


def inject_dirty(spark: SparkSession, dataset: str, n: int, share: float, seed: int = 42,
                 as_of: str | None = None, sizes: dict | None = None) -> DataFrame:
    """The clean rows plus ``int(n * share)`` copies of randomly chosen rows,
    each with one null non-key field, an 'invalid-date' date, or unchanged
    (an exact duplicate).  Keys are kept."""
    as_of = as_of or _dt.date.today().isoformat()
    sizes = {**DEFAULT_SIZES, **(sizes or {})}
    cols = RAW_COLUMNS[dataset]
    clean = generate(spark, dataset, n, seed, as_of, sizes)
    k = int(n * share)
    if k == 0:
        return clean
    j = F.col("id")
    src = _randint(seed, f"{dataset}.dirty.pick", j, 0, n - 1).cast("long")
    kind = _randint(seed, f"{dataset}.dirty.kind", j, 0, 2)             # 0 null, 1 bad date, 2 duplicate
    non_key = cols[1:]
    dates = [c for c in cols if "date" in c]
    null_col = _choice(seed, f"{dataset}.dirty.nullcol", j, non_key)
    date_col = _choice(seed, f"{dataset}.dirty.datecol", j, dates) if dates else F.lit(None)
    copies = spark.range(k).select(src.alias("src"), kind.alias("kind"), null_col.alias("nc"),
                                   date_col.alias("dc"))
    exprs = _rows(dataset, F.col("src"), seed, as_of, sizes)
    out = []
    for c, e in zip(cols, exprs):
        v = F.when((F.col("kind") == 0) & (F.col("nc") == c), F.lit(None).cast("string"))
        v = v.when((F.col("kind") == 1) & (F.col("dc") == c), F.lit("invalid-date")).otherwise(e)
        out.append(v.alias(c))
    return clean.unionByName(copies.select(*out))


def generate_all(spark: SparkSession, out_dir: str, scale: float = 1.0, seed: int = 42,
                 as_of: str | None = None) -> dict[str, str]:
    """S4 (+ S3): the five datasets at the default sizes x ``scale``, dirty
    shares 3 / 2 / 4 %, written as CSV folders ``<out_dir>/<name>.csv``."""
    sizes = {k: max(1, int(v * scale)) for k, v in DEFAULT_SIZES.items()}
    paths = {}
    for name in ["patients", "physicians", "prescriptions", "diagnoses", "claims"]:
        share = DIRTY_SHARE.get(name, 0.0)
        df = (inject_dirty(spark, name, sizes[name], share, seed, as_of, sizes) if share
              else generate(spark, name, sizes[name], seed, as_of, sizes))
        paths[name] = write_csv(df, f"{out_dir.rstrip('/')}/{name}.csv")
    return paths
