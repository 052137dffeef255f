"""Table IO: a folder of parquet tables (or a JDBC database), and the
operational sinks (staging, quarantine, DQ report, run log, model).

A table is a folder ``<root>/<name>`` of versions, each a parquet folder, and a
small file ``_current`` that names the one in force.  A full replace (S8/S9/I3)
writes a new version and then renames a new ``_current`` over the old one.  So a
plan that reads the table it replaces never loses its input, and a job that
dies at any point leaves the old table or the new one, never none.
"""

from __future__ import annotations

import datetime as _dt
import logging
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cleaning import ts_literal
from ..schemas import DQ_SCORES, PIPELINE_RUNS
from ..session import reliable_checkpoint

log = logging.getLogger(__name__)


class TableStore:
    """Named tables under one root folder (shared storage on a cluster).

    ``fmt='jdbc'`` (S16) reads / writes the same names through a JDBC URL;
    it needs a database reachable from the executors and is not exercised by
    the tests here.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet",
                 jdbc_url: str | None = None, jdbc_props: dict | None = None):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt
        self.jdbc_url, self.jdbc_props = jdbc_url, dict(jdbc_props or {})

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        if self.fmt == "jdbc":
            try:
                self.read(name).schema  # noqa: B018
                return True
            except Exception:  # noqa: BLE001
                return False
        return self.current(name) is not None

    def current(self, name: str) -> str | None:
        """The folder of the version in force; None without a table."""
        p, fs = self._fs(f"{self.path(name)}/_current")
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            tag = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return f"{self.path(name)}/{tag}"

    def read(self, name: str) -> DataFrame:
        """A table as a DataFrame (lazy)."""
        if self.fmt == "jdbc":
            return self.spark.read.jdbc(self.jdbc_url, name, properties=self.jdbc_props)
        path = self.current(name)
        if path is None:
            raise FileNotFoundError(f"no table {name} under {self.root}")
        return self.spark.read.parquet(path)

    def read_or_none(self, name: str) -> DataFrame | None:
        return self.read(name) if self.exists(name) else None

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def write(self, df: DataFrame, name: str, mode: str = "overwrite",
              partition_by: list[str] | None = None) -> None:
        """Write a table (full replace by default; ``append`` adds to the version in force)."""
        if self.fmt == "jdbc":
            df.write.mode(mode).jdbc(self.jdbc_url, name, properties=self.jdbc_props)
            return
        path = self.current(name) if mode == "append" else None
        if path is None:
            self.replace(df, name, partition_by)
            return
        w = df.write.mode("append")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(path)

    def replace(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> None:
        """Full replace that may read ``name`` itself (see the module text).
        The version before the new one stays for plans that still read it; older
        ones are deleted."""
        if self.fmt == "jdbc":
            self.write(reliable_checkpoint(df), name, "overwrite", partition_by)
            return
        before, tag = self.current(name), uuid.uuid4().hex[:12]
        w = df.write.mode("errorifexists")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{self.path(name)}/{tag}")
        self._publish(name, tag)
        folder, fs = self._fs(self.path(name))
        for status in fs.listStatus(folder):
            old = status.getPath().getName()
            if status.isDirectory() and old != tag and not (before or "").endswith(f"/{old}"):
                fs.delete(status.getPath(), True)

    def _publish(self, name: str, tag: str) -> None:
        """Make version ``tag`` the one in force by one rename."""
        jvm = self.spark.sparkContext._jvm
        new, fs = self._fs(f"{self.path(name)}/_next_{tag}")
        stream = fs.create(new, True)
        try:
            stream.writeBytes(tag)
        finally:
            stream.close()
        current, _ = self._fs(f"{self.path(name)}/_current")
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        files.rename(fs.makeQualified(new), fs.makeQualified(current), options)

    def create_if_absent(self, schemas: dict[str, T.StructType]) -> list[str]:
        """Create empty typed tables that do not exist; return the created names."""
        made = []
        for name, schema in schemas.items():
            if not self.exists(name):
                self.write(self.spark.createDataFrame([], schema), name, "overwrite")
                made.append(name)
        return made


def numbered_files(df: DataFrame) -> DataFrame:
    """``_file`` as a number in the order of the paths: rows that are sorted and shuffled
    by arrival do not carry a path each.  One row per file; its size decides the join."""
    if "_file" not in df.columns:
        return df
    files = df.select(F.col("_file").alias("_path")).distinct()
    files = reliable_checkpoint(files.withColumn("_place", F.row_number().over(Window.orderBy("_path"))))
    joined = df.join(files, F.col("_file").eqNullSafe(F.col("_path")))
    return joined.select(*[F.col("_place").alias("_file") if c == "_file" else F.col(c) for c in df.columns])


def load_staging(store: TableStore, df: DataFrame, table: str, key: str,
                 batch_ts: _dt.datetime, order: list[str] | None = None) -> int:
    """Stamp ``ingested_at``, keep the last row per key (by file, then row
    number, unless ``order`` says otherwise), replace the table.  An empty input
    leaves the table as it was.  Returns the rows loaded (counted while writing,
    no second pass)."""
    from ..operators.warehouse import dedup_keep_last

    if df.isEmpty():
        return 0
    rows = numbered_files(df)
    order = [c for c in (order if order is not None else ["_file", "_row_number"]) if c in rows.columns and c != "ingested_at"]
    if "ingested_at" in rows.columns:
        rows = rows.withColumn("ingested_at", ts_literal(batch_ts))
    # a new stamp comes behind the shuffle
    deduped = dedup_keep_last(rows, key, order).withColumn("ingested_at", ts_literal(batch_ts))
    deduped = deduped.drop(*[c for c in ("_row_number", "_file") if c in deduped.columns])
    obs = Observation(f"load_{table}")
    store.replace(deduped.observe(obs, F.count(F.lit(1)).alias("rows")), table)
    return int(obs.get["rows"])


def quarantine(invalid: DataFrame, root: str, source: str, batch_ts: _dt.datetime | str) -> int:
    """Write invalid rows (raw text, error, row number) under
    ``root/source=<name>/batch_ts=<stamp>``; nothing is written when empty.
    The same source and stamp again replace their own rows, so a repeated batch
    is not stored twice.  ``batch_ts`` may be any text that names the batch."""
    stamp = batch_ts if isinstance(batch_ts, str) else batch_ts.strftime("%Y%m%d_%H%M%S")
    if invalid.isEmpty():
        return 0
    obs = Observation(f"quarantine_{source}")
    rows = invalid.drop("_corrupt").observe(obs, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("overwrite").parquet(f"{root.rstrip('/')}/source={source}/batch_ts={stamp}")
    return int(obs.get["rows"])


def save_dq_report(store: TableStore, report: DataFrame, report_root: str,
                   run_ts: _dt.datetime) -> str:
    """Write the report (one row) as JSON and append one dq_scores row.  The
    checks behind the report run once, not for each of the two."""
    report = reliable_checkpoint(report)
    stamp = run_ts.strftime("%Y%m%d_%H%M%S")
    path = f"{report_root.rstrip('/')}/dq_report_{stamp}"
    report.write.mode("overwrite").json(path)
    store.write(dq_score_row(report, f"dq_{stamp}", run_ts, path), "dq_scores", mode="append")
    return path


def dq_score_row(report: DataFrame, run_id: str, run_ts, report_path: str) -> DataFrame:
    """The dq_scores row of a report."""
    return report.select(
        F.lit(run_id).alias("run_id"), ts_literal(run_ts).alias("run_timestamp"),
        F.col("total_checks").cast("int").alias("total_checks"),
        F.col("passed").cast("int").alias("passed_checks"),
        F.col("overall_score").cast("decimal(5,4)").alias("overall_score"),
        F.lit(report_path).alias("report_path")).select(*DQ_SCORES.names)


def record_pipeline_run(store: TableStore, name: str, status: str, started: _dt.datetime,
                        completed: _dt.datetime, processed: int, failed: int) -> str:
    """Append one pipeline_runs row; run_id = name_YYYYmmdd_HHMMSS."""
    run_id = f"{name}_{completed.strftime('%Y%m%d_%H%M%S')}"
    row = store.spark.createDataFrame(
        [(run_id, name, status, started, completed, int(processed), int(failed))], PIPELINE_RUNS)
    store.write(row, "pipeline_runs", mode="append")
    return run_id
