"""A landing folder of raw CSV files written from the driver's test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_COLUMNS
from ..sources import fixtures
from ..sources.csv import write_csv


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five raw datasets as text columns in the order of the files."""
    staged = {"patients": fixtures.patients_stage(spark, sf_dir), "physicians": fixtures.physicians_stage(spark, sf_dir),
              "diagnoses": fixtures.dx_stage(spark, sf_dir).withColumn("physician_id", F.lit("none-known"))}
    raw = {"prescriptions": fixtures.rx_raw(spark, sf_dir), "claims": fixtures.claims_raw(spark, sf_dir), **staged}
    genders = F.when(F.col("gender").isin("BUILDING", "MACHINERY"), "M").otherwise("F")  # within the allowed values
    raw["patients"] = raw["patients"].withColumn("gender", genders)
    return {name: df.select(*[F.col(c).cast("string").alias(c) for c in RAW_COLUMNS[name]]) for name, df in raw.items()}


def write_landing(spark: SparkSession, sf_dir: str, raw_dir: str) -> None:
    """Write ``<raw_dir>/<dataset>.csv`` for every dataset (one part file a task)."""
    for name, df in raw_tables(spark, sf_dir).items():
        write_csv(df, f"{raw_dir}/{name}.csv")
