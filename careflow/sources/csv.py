"""Raw CSV scan (S5) with a per-file 1-based row number.

The column list comes from the header line; every column is read as text
(no schema inference pass), plus a corrupt-record column that catches short
and long lines.  A file whose header names other columns, or the same in
another order, is an error, not a silent mix-up.  Files are split into blocks
as usual; records that span lines need ``multiline=True``, which reads each
file whole.

The CSV is parsed once, into a table in the shared folder.  Row numbers are
exact and distributed: rows of one (file, block) are consecutive within a
task, so ``monotonically_increasing_id`` minus the block's first id is the
position inside the block; a block's offset is the row count of the earlier
blocks of the same file, computed over one row per input split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import reliable_checkpoint

CORRUPT = "_corrupt"


def header_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header line (reads only the first line)."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path).columns


def read_raw_csv(spark: SparkSession, path: str, columns: list[str] | None = None,
                 multiline: bool = False, row_number: bool = True) -> DataFrame:
    cols = columns or header_columns(spark, path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in cols]
                          + [T.StructField(CORRUPT, T.StringType())])
    df = (spark.read.schema(schema)
          .option("header", True).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT)
          .option("escape", '"').option("multiLine", multiline).option("enforceSchema", False)
          .csv(path))
    if not row_number:
        return df
    return with_file_row_number(df)


def with_file_row_number(df: DataFrame, out: str = "_row_number", path_col: str | None = None,
                         block_col: str | None = None) -> DataFrame:
    """1-based row position inside its source file (header excluded), plus
    ``_file`` (the file path).  ``path_col`` / ``block_col`` name columns that
    already hold the file path and block start (a streaming micro-batch);
    by default they come from the ``_metadata`` column of a file scan."""
    path = F.col(path_col) if path_col else F.col("_metadata.file_path")
    blk = F.col(block_col) if block_col else F.col("_metadata.file_block_start")
    base = df.select("*", path.alias("_file"), F.xxhash64(path).alias("_fk"), blk.alias("_blk"),
                     F.monotonically_increasing_id().alias("_mid"))
    base = reliable_checkpoint(base.drop(*[c for c in (path_col, block_col) if c]))  # parsed once
    blocks = (base.groupBy("_fk", "_blk")
              .agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n")))
    blocks = blocks.withColumn(
        "_off", F.sum("_n").over(Window.partitionBy("_fk").orderBy("_blk")) - F.col("_n")).drop("_n")
    blocks = reliable_checkpoint(blocks)  # one row per input split; its size decides the join
    numbered = (base.join(blocks, ["_fk", "_blk"])
                .withColumn(out, F.col("_off") + (F.col("_mid") - F.col("_first")) + F.lit(1))
                .drop("_fk", "_blk", "_mid", "_first", "_off"))
    numbered._careflow_path = base._careflow_path    # for drop_checkpoint
    return numbered


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """S3: CSV with header (one part file per task)."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)
    return path
