"""I4: incremental ingest as a Structured Streaming job.

New CSV files landing in a folder are read by the file source; each
micro-batch is validated (V1-V8), its invalid rows quarantined (S11), its
valid rows reduced to the last row per key (V9) and upserted into the target
table (I3).  The stream's checkpoint records which files were processed, so
it replaces the high-water mark of the batch form (I1/I2): a file is taken
exactly once, also after a restart.  ``trigger(availableNow=True)`` processes
what is there and stops -- the scheduled-batch way of running it.

The target is a table of a ``TableStore`` (a full replace per micro-batch, the
order of processing decides) or of a ``BucketStore``.  There a row keeps where it
came from (``arrival_file``, ``arrival_row``), the greater place wins whatever the
order in which files are processed, a micro-batch reads and writes only the
buckets of its keys, and the commit names the epoch, so an epoch that is run
again changes nothing.
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cleaning import ts_literal
from ..operators import incremental, validate
from ..schemas import KEYS, RAW_COLUMNS, STAGING_TABLE
from ..session import drop_checkpoint, reliable_checkpoint
from ..sources import tables
from ..sources.buckets import BucketStore
from ..sources.csv import CORRUPT, with_file_row_number
from ..sources.tables import TableStore


def raw_stream(spark: SparkSession, landing_dir: str, dataset: str,
               max_files_per_trigger: int | None = None, multiline: bool = False) -> DataFrame:
    """New files as raw text rows.  A header that names other columns, or the same
    in another order, stops the stream; ``multiline`` reads records that span lines."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[dataset]]
                          + [T.StructField(CORRUPT, T.StringType())])
    r = (spark.readStream.schema(schema).option("header", True).option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", CORRUPT).option("escape", '"')
         .option("enforceSchema", False).option("multiLine", multiline))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(landing_dir).select(
        "*", F.col("_metadata.file_path").alias("_mpath"), F.col("_metadata.file_block_start").alias("_mblk"))


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps with its checkpoint folder."""
    return spark.read.text(f"{checkpoint.rstrip('/')}/metadata").select(F.get_json_object("value", "$.id")).first()[0]


#: Where a row of a bucketed target came from; the greater place is the later one.
ARRIVAL = ["arrival_file", "arrival_row"]


def later_rows(rows: DataFrame, target: DataFrame | None, key: str) -> DataFrame:
    """Of ``rows`` (key, ARRIVAL and others) the last of each key, if it is later than
    the target's row of that key: what an upsert has to change."""
    last = incremental.dedup_keep_last(rows, key, ARRIVAL)
    if target is None:
        return last
    known = target.select(F.col(key).alias("_key"), F.struct(*ARRIVAL).alias("_place"))
    there = F.col(key).eqNullSafe(F.col("_key")) & (F.struct(*ARRIVAL) <= F.col("_place"))
    return last.join(known, there, "left_anti")


def _bucket_handler(store: BucketStore, dataset: str, quarantine_root: str, checkpoint: str):
    key, table = KEYS[dataset], STAGING_TABLE[dataset]

    def handle(batch: DataFrame, epoch_id: int) -> None:
        stream = query_id(batch.sparkSession, checkpoint)
        commit, mark = store.begin(), f"stream {stream}"
        if int(commit.marks.get(mark) or -1) >= epoch_id:    # committed before the stream could say so
            return
        stamp = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        numbered = with_file_row_number(batch, path_col="_mpath", block_col="_mblk")
        checked = reliable_checkpoint(validate.validate(numbered, dataset))
        changed = None
        try:
            valid, invalid = validate.split(checked, dataset)
            tables.quarantine(invalid, quarantine_root, dataset, f"{stream}_epoch_{epoch_id}")
            rows = (valid.withColumn("ingested_at", ts_literal(stamp))
                    .withColumn("arrival_file", F.element_at(F.split("_file", "/"), -1)).withColumnRenamed("_row_number", "arrival_row")
                    .drop("_file"))
            target = commit.read(table, commit.touched(table, rows, key)) if commit.has(table) else None
            changed = reliable_checkpoint(later_rows(rows, target, key))
            if target is None or not changed.isEmpty():
                commit.upsert(table, changed, key)
            commit.marks[mark] = str(epoch_id)
            commit.publish()
            store.vacuum()
        finally:
            drop_checkpoint(checked)
            if changed is not None:
                drop_checkpoint(changed)

    return handle


def _batch_handler(store: TableStore, dataset: str, quarantine_root: str, checkpoint: str):
    key, table = KEYS[dataset], STAGING_TABLE[dataset]

    def handle(batch: DataFrame, epoch_id: int) -> None:
        stamp = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        numbered = with_file_row_number(batch, path_col="_mpath", block_col="_mblk")
        checked = reliable_checkpoint(validate.validate(numbered, dataset))
        try:
            valid, invalid = validate.split(checked, dataset)
            # named by stream and epoch, so an epoch that is run again replaces its own rows and no other stream's
            tables.quarantine(invalid, quarantine_root, dataset, f"{query_id(batch.sparkSession, checkpoint)}_epoch_{epoch_id}")
            delta = tables.numbered_files(valid).withColumn("ingested_at", ts_literal(stamp))
            target = store.read_or_none(table)
            if target is None:
                new = incremental.dedup_keep_last(delta, key)
            else:
                new = incremental.upsert(target, delta, key)
            # the new table reads the old one: replace() writes beside it, then swaps
            store.replace(new.drop("_file", "_row_number"), table)
        finally:
            drop_checkpoint(checked)

    return handle


def start(spark: SparkSession, landing_dir: str, dataset: str, store: TableStore | BucketStore, quarantine_root: str,
          checkpoint: str, available_now: bool = True, max_files_per_trigger: int | None = None,
          multiline: bool = False):
    """Start the stream; returns the StreamingQuery.  ``max_files_per_trigger``
    bounds each micro-batch when a large backlog of files is waiting."""
    handler = _bucket_handler if isinstance(store, BucketStore) else _batch_handler
    w = (raw_stream(spark, landing_dir, dataset, max_files_per_trigger, multiline).writeStream
         .foreachBatch(handler(store, dataset, quarantine_root, checkpoint))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def files_per_batch(spark: SparkSession, landing_dir: str, least: int, most_batches: int) -> int:
    """Files of a micro-batch so that those which lie in the folder take ``most_batches`` at most."""
    waiting = len(spark.read.text(landing_dir).inputFiles())
    return max(least, math.ceil(waiting / most_batches))


def run_available(spark: SparkSession, landing_dir: str, dataset: str, store: TableStore | BucketStore,
                  quarantine_root: str, checkpoint: str, max_files_per_trigger: int | None = None,
                  multiline: bool = False, most_batches: int | None = None) -> DataFrame:
    """Process every file that is there now (in batches of at most
    ``max_files_per_trigger`` files), then return the target table.  A batch whose
    keys lie anywhere rewrites the whole table, so many small batches of a large
    backlog cost its square: with ``most_batches`` the batches take more files where
    there would be more batches than that."""
    if max_files_per_trigger and most_batches:
        max_files_per_trigger = files_per_batch(spark, landing_dir, max_files_per_trigger, most_batches)
    q = start(spark, landing_dir, dataset, store, quarantine_root, checkpoint, available_now=True,
              max_files_per_trigger=max_files_per_trigger, multiline=multiline)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return store.read(STAGING_TABLE[dataset])
