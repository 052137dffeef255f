"""Ingest jobs (S6, S7): raw CSV -> validation -> quarantine + staging."""

from __future__ import annotations

import datetime as _dt
import logging
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import validate as V
from ..session import drop_checkpoint
from ..schemas import KEYS, STAGING_TABLE
from ..sources import tables
from ..sources.csv import read_raw_csv, with_file_row_number
from ..sources.tables import TableStore

log = logging.getLogger(__name__)

# File name of each dataset.
FILES = [("patients.csv", "patients"), ("physicians.csv", "physicians"),
         ("prescriptions.csv", "prescriptions"), ("diagnoses.csv", "diagnoses"), ("claims.csv", "claims")]


def ingest_file(spark: SparkSession, path: str, dataset: str, store: TableStore, quarantine_root: str,
                batch_ts: _dt.datetime | None = None, multiline: bool = False) -> dict:
    """Validate one dataset file, quarantine the invalid rows, load the
    valid ones (coerced, last row per key) into its staging table.

    ``multiline``: records may span lines inside quotes (such a file cannot be
    split, so one task reads it)."""
    if dataset not in STAGING_TABLE:
        raise ValueError(f"no dataset is called {dataset}; there are {sorted(STAGING_TABLE)}")
    batch_ts = batch_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    raw = read_raw_csv(spark, path, multiline=multiline, row_number=False)
    placed = raw.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"))
    # parsed and validated once, into the one table that both sinks read
    numbered = with_file_row_number(V.validate(placed, dataset), path_col="_path", block_col="_block")
    checked = numbered.select(*raw.columns, "_file", "_row_number", V.ERROR_COL)
    try:
        err = F.col(V.ERROR_COL)
        tally = checked.agg(F.count_if(err.isNull()).alias("valid"), F.count_if(err.isNotNull()).alias("invalid")).first()
        valid, invalid = V.split(checked, dataset)
        stem = os.path.splitext(os.path.basename(path.rstrip("/")))[0]
        n_bad = tables.quarantine(invalid, quarantine_root, stem, batch_ts)
        n_ok = tables.load_staging(store, valid, STAGING_TABLE[dataset], KEYS[dataset], batch_ts)
    finally:
        drop_checkpoint(numbered)
    return {"file": path, "dataset_type": dataset, "records_loaded": n_ok,
            "records_valid": int(tally["valid"]), "records_invalid": int(tally["invalid"]),
            "records_quarantined": n_bad, "timestamp": batch_ts.isoformat()}


def ingest_all(spark: SparkSession, data_dir: str, store: TableStore, quarantine_root: str,
               batch_ts: _dt.datetime | None = None, multiline: bool = False) -> list[dict]:
    """Ingest the five datasets; a missing file is skipped with a warning."""
    results = []
    for fname, dataset in FILES:
        path = f"{data_dir.rstrip('/')}/{fname}"
        if not _exists(spark, path):
            log.warning("no file for %s at %s; dataset left out", dataset, path)
            continue
        results.append(ingest_file(spark, path, dataset, store, quarantine_root, batch_ts, multiline))
    return results


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
