"""Spark session set-up shared by jobs, tests and the benchmark.

Only settings a Spark user sets for this workload: adaptive execution with
skew handling, UTC session time zone, ANSI mode (bad casts must be explicit
``try_*``), no web UI.  The checkpoint folder is read from the session; a
folder is set here only when the cluster has not named one (local tests).
"""

from __future__ import annotations

import atexit
import math
import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Let AQE split a skewed shuffle partition in rebalance / aggregation too.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(master: str | None = None, app_name: str = "careflow",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a private one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/...).
    A machine-local temporary folder is only acceptable for local runs; any
    other master without a configured folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="careflow-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def ship_code(spark: SparkSession) -> None:
    """Send this package's sources to the Python workers, once per context, so
    that functions run by ``mapInPandas`` and the like can import it wherever
    the executors run (what ``spark-submit --py-files`` does for a job)."""
    sc = spark.sparkContext
    if getattr(sc, "_careflow_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="careflow-code-"), "careflow_code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("careflow", os.path.relpath(path, package)))
    sc.addPyFile(archive)
    sc._careflow_shipped = True


_SCRATCH: dict[str, set[str]] = {}   # application -> its intermediate tables


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables; what
    lies there is deleted when the driver's Python ends (or by ``drop_scratch``)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    sc = spark.sparkContext
    if sc.applicationId not in _SCRATCH:
        _SCRATCH[sc.applicationId] = set()
        atexit.register(lambda: drop_scratch(spark) if sc._jsc is not None else None)
    _SCRATCH[sc.applicationId].add(f"{base}/{name}")
    return f"{base}/{name}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; frames that read them end here."""
    sc = spark.sparkContext
    paths = _SCRATCH.get(sc.applicationId, set())
    while paths:
        p = sc._jvm.org.apache.hadoop.fs.Path(paths.pop())
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def reliable_checkpoint(df):
    """Cut lineage: write ``df`` once as a parquet table in the shared folder and
    read it back.  A lost executor loses nothing, later reads prune columns and
    push filters, and every reader sees the same rows."""
    path = scratch_path(df.sparkSession, f"careflow-table-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._careflow_path = path
    return out


#: Bytes of a task that reads tables and sorts their rows for a write, at most.
SPLIT = 8 << 20
#: The same for a task of ``dealt_checkpoint``, which writes a file a bucket: each costs.
DEALT_SPLIT = 32 << 20
#: Rows from which tables are dealt out; rows of a bucket, at most, that a task sorts in memory.
DEALT_ROWS, BUCKET_ROWS = 50_000, 2_000_000


@contextmanager
def splits(spark: SparkSession, size: int | None):
    """Scans planned in here take at most ``size`` bytes a task (None: as the session says);
    small files are read many to a task."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = [spark.conf.get(name, None) for name in names]
    if size is not None:
        for name, value in zip(names, [size, size // 64], strict=True):
            spark.conf.set(name, f"{value}b")
    try:
        yield
    finally:
        for name, value in zip(names, before, strict=True):
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def dealt_buckets(spark: SparkSession, rows: int) -> int:
    """Buckets for ``dealt_checkpoint`` of so many rows: a task of the cluster each, or a
    multiple of that where buckets would be too large."""
    tasks = spark.sparkContext.defaultParallelism
    return max(1, min(tasks * math.ceil(rows / BUCKET_ROWS / tasks), math.ceil(rows / DEALT_ROWS)))


def dealt_checkpoint(df, key: str, buckets: int):
    """``reliable_checkpoint`` as a Spark table in hash buckets of ``key``: rows are not
    shuffled for it, every task writes a file a bucket.  Aggregations, windows and joins
    by ``key`` with tables of as many buckets then shuffle nothing.  Columns in
    compressed files are a small part of the bytes that a shuffle writes and reads
    for the same rows.  The catalog forgets the table at once; the frame keeps it."""
    spark, name = df.sparkSession, f"careflow_dealt_{uuid.uuid4().hex[:12]}"
    path = scratch_path(spark, name)
    with splits(spark, DEALT_SPLIT):
        (df.write.option("compression", "zstd").option("path", path).bucketBy(buckets, key).saveAsTable(name))
    out = spark.table(name)
    out.schema  # noqa: B018  (resolved while the catalog has it)
    spark.sql(f"DROP TABLE {name}")     # a table with a path of its own: the files stay
    out._careflow_path = path
    return out


def keyed_checkpoint(df, key: str, buckets: int):
    """``dealt_checkpoint``, of few rows (one bucket) ``reliable_checkpoint``."""
    return dealt_checkpoint(df, key, buckets) if buckets > 1 else reliable_checkpoint(df)


def drop_checkpoint(df) -> None:
    """Delete the table behind a frame of ``reliable_checkpoint`` (call it when no
    plan reads it any more)."""
    path = getattr(df, "_careflow_path", None)
    if path:
        sc = df.sparkSession.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
