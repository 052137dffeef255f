"""Domain staging tables derived from the driver's test tables.

The driver ships TPC-H-like tables; this module maps them onto the five
staging datasets of the care-pathway domain, once as Spark DataFrames and
once as SQL text for the DuckDB oracle.  The two forms must stay equal, so
they live side by side.

Mapping: patient = customer / order customer / event user, physician =
supplier, prescription = lineitem line (drug = part brand, therapy area =
part type), diagnosis = event, claim = order, region = region name.

Dirty values are injected by rules on ordinary data columns (never by
dropping rows): an unparseable prescription date on lines with the top
discount and a high tax, an unparseable birth date for customers with a
large negative balance, so the cleaning steps have work to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import dealt_buckets, dealt_checkpoint

# Fixed values of the mapping.
AS_OF = "2025-01-01"              # SCD effective_from and detection date in checks
BAD_DATE = "not-a-date"
RX_BAD_DATE_DISCOUNT = 0.095    # l_discount >= this and l_tax >= RX_BAD_DATE_TAX -> bad date (~3 %)
RX_BAD_DATE_TAX = 0.055
DOB_BAD_BALANCE = -900           # c_acctbal < this -> unparseable date of birth (~1 %)
NONE_DRUG_PRICE = 2000           # l_extendedprice < this -> drug name 'None' in the raw text (~1 %)
# Arrival order used for keep-last on the prescription fixture (no batch stamp).
RX_ORDER = ["prescription_date", "physician_id", "source_part", "quantity", "source_price"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _regions(spark, sf_dir) -> DataFrame:
    # nation (25 rows) and region (5 rows) are fixed-size reference tables:
    # broadcasting them is bounded by definition.
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return F.broadcast(n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name"))


def _iso(c):
    return F.date_format(c, "yyyy-MM-dd")


def rx_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rx_rows(spark, sf_dir).drop("_cheap")


def rx_dealt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rx_stage`` without its source columns, for jobs that write it: of many rows those
    that meet the parts are dealt out to files by the key (``dealt_checkpoint``), not shuffled."""
    buckets = dealt_buckets(spark, table(spark, sf_dir, "lineitem").count())
    return _rx_rows(spark, sf_dir, buckets).drop("_cheap", "source_part", "source_price")


def _rx_rows(spark: SparkSession, sf_dir: str, buckets: int = 1) -> DataFrame:
    """``rx_stage`` and ``_cheap``, whether the price is below ``NONE_DRUG_PRICE``.
    ``buckets``: deal lines and parts out to so many, which leaves the price out."""
    # values as narrow as the result has them, before the joins shuffle them
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int").alias("quantity"),
        "l_extendedprice", (F.col("l_extendedprice") < NONE_DRUG_PRICE).alias("_cheap"), F.col("l_shipdate").cast("date").alias("shipped"),
        ((F.col("l_discount") >= RX_BAD_DATE_DISCOUNT) & (F.col("l_tax") >= RX_BAD_DATE_TAX)).alias("bad_date"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    if buckets > 1:
        li = li.drop("l_extendedprice", "_cheap")
        li = dealt_checkpoint(li.join(o, li.l_orderkey == o.o_orderkey).drop("o_orderkey"), "l_partkey", buckets)
        p = dealt_checkpoint(p, "p_partkey", buckets)
        j = li.join(p.hint("shuffle_hash"), li.l_partkey == p.p_partkey).withColumns({"l_extendedprice": F.lit(None), "_cheap": F.lit(None)})
    else:
        j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    return j.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("prescription_id"),
        F.col("o_custkey").alias("patient_id"),
        F.col("l_suppkey").alias("physician_id"),
        F.col("p_brand").alias("drug_name"),
        F.when(F.col("bad_date"), F.lit(BAD_DATE)).otherwise(_iso(F.col("shipped"))).alias("prescription_date"),
        "quantity",
        F.col("l_linenumber").alias("refills"),
        F.col("p_type").alias("therapy_area"),
        F.col("l_partkey").alias("source_part"),
        F.col("l_extendedprice").alias("source_price"), "_cheap",
    )


def dx_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return e.select(
        F.col("event_id").alias("diagnosis_id"),
        F.col("user_id").alias("patient_id"),
        F.col("event_type").alias("icd_code"),
        F.col("ts").cast("date").alias("diagnosis_date"),
        F.lit(None).cast("bigint").alias("physician_id"),
        F.when(F.col("value") < 10, "mild").when(F.col("value") < 50, "moderate")
         .otherwise("severe").alias("severity"),
        F.col("ts").alias("ingested_at"),
    )


def claims_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("claim_id"),
        F.col("o_custkey").alias("patient_id"),
        F.col("o_orderdate").cast("date").alias("claim_date"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("amount"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("payer"),
    )


def patients_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal")
    j = c.join(_regions(spark, sf_dir), c.c_nationkey == F.col("n_nationkey"))
    dob = F.date_add(F.lit("1940-01-01").cast("date"), (F.col("c_custkey") % 20000).cast("int"))
    enrol = F.date_add(F.lit("2015-01-01").cast("date"), (F.col("c_custkey") % 2500).cast("int"))
    return j.select(
        F.col("c_custkey").alias("patient_id"),
        F.col("c_mktsegment").alias("gender"),
        F.when(F.col("c_acctbal") < DOB_BAD_BALANCE, F.lit(BAD_DATE))
         .otherwise(_iso(dob)).alias("date_of_birth"),
        F.col("r_name").alias("region"),
        _iso(enrol).alias("enrollment_date"),
    )


def physicians_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    j = s.join(_regions(spark, sf_dir), s.s_nationkey == F.col("n_nationkey"))
    return j.select(
        F.col("s_suppkey").alias("physician_id"),
        F.col("s_name").alias("specialty"),
        F.col("r_name").alias("region"),
        F.col("s_nationkey").alias("years_experience"),
    )


def rx_raw(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """Raw (all-text) prescriptions as a CSV would hold them, with dirt:
    'None' drug names on the cheapest lines and quantities shifted below the
    minimum (quantity > 45 -> quantity - 50).  ``parts``: so many partitions by the key,
    dealt out before the values are text."""
    r = _rx_rows(spark, sf_dir).select(
        "prescription_id", "patient_id", "physician_id",
        F.when(F.col("_cheap"), F.lit("None")).otherwise(F.col("drug_name")).alias("drug_name"), "prescription_date",
        F.when(F.col("quantity") > 45, F.col("quantity") - 50).otherwise(F.col("quantity")).alias("quantity"),
        "refills", "therapy_area")
    if parts is not None:
        r = r.repartition(parts, "prescription_id")
    return r.select(*[F.col(c).cast("string").alias(c) for c in r.columns])


def claims_raw(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """Raw (all-text) claims; order status F/O/P -> approved / pending / 'partial'
    (the last is outside the allowed values).  ``parts`` as in ``rx_raw``."""
    o = table(spark, sf_dir, "orders")
    if parts is not None:
        o = o.repartition(parts, "o_orderkey")
    status = (F.when(F.col("o_orderstatus") == "F", "approved")
               .when(F.col("o_orderstatus") == "O", "pending").otherwise("partial"))
    return o.select(
        F.col("o_orderkey").cast("string").alias("claim_id"),
        F.col("o_custkey").cast("string").alias("patient_id"),
        _iso(F.col("o_orderdate").cast("date")).alias("claim_date"),
        F.col("o_totalprice").cast("string").alias("amount"),
        status.alias("status"), F.col("o_orderpriority").alias("payer"))


# ---------------------------------------------------------------------------
# The same staging tables as DuckDB SQL (oracle side).

SQL_VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {}


def _view(name: str, body: str, *deps: str) -> None:
    SQL_VIEWS[name] = (body, deps)


_view("regions", """
  SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey""")

_view("rx_stage", f"""
  SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS prescription_id,
         o_custkey AS patient_id, l_suppkey AS physician_id, p_brand AS drug_name,
         CASE WHEN l_discount >= {RX_BAD_DATE_DISCOUNT} AND l_tax >= {RX_BAD_DATE_TAX} THEN '{BAD_DATE}'
              ELSE strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') END AS prescription_date,
         CAST(l_quantity AS INTEGER) AS quantity, l_linenumber AS refills, p_type AS therapy_area,
         l_partkey AS source_part, l_extendedprice AS source_price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""")

_view("dx_stage", """
  SELECT event_id AS diagnosis_id, user_id AS patient_id, event_type AS icd_code,
         CAST(ts AS DATE) AS diagnosis_date, CAST(NULL AS BIGINT) AS physician_id,
         CASE WHEN value < 10 THEN 'mild' WHEN value < 50 THEN 'moderate' ELSE 'severe' END AS severity,
         ts AS ingested_at
  FROM events""")

_view("claims_stage", """
  SELECT o_orderkey AS claim_id, o_custkey AS patient_id, CAST(o_orderdate AS DATE) AS claim_date,
         CAST(o_totalprice AS DECIMAL(10,2)) AS amount, o_orderstatus AS status, o_orderpriority AS payer
  FROM orders""")

_view("patients_stage", f"""
  SELECT c_custkey AS patient_id, c_mktsegment AS gender,
         CASE WHEN c_acctbal < {DOB_BAD_BALANCE} THEN '{BAD_DATE}'
              ELSE strftime(DATE '1940-01-01' + CAST(c_custkey % 20000 AS INTEGER), '%Y-%m-%d') END AS date_of_birth,
         r_name AS region,
         strftime(DATE '2015-01-01' + CAST(c_custkey % 2500 AS INTEGER), '%Y-%m-%d') AS enrollment_date
  FROM customer JOIN regions ON c_nationkey = n_nationkey""", "regions")

_view("physicians_stage", """
  SELECT s_suppkey AS physician_id, s_name AS specialty, r_name AS region,
         s_nationkey AS years_experience
  FROM supplier JOIN regions ON s_nationkey = n_nationkey""", "regions")


def sql_with(body: str, *names: str) -> str:
    """Prefix ``body`` with the WITH clause for ``names`` and their dependencies."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        if n in ordered:
            return
        for d in SQL_VIEWS[n][1]:
            visit(d)
        ordered.append(n)

    for n in names:
        visit(n)
    if not ordered:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({SQL_VIEWS[n][0]}\n)" for n in ordered)
    return f"WITH {ctes}\n{body.strip()}"

_view("rx_raw", f"""
  SELECT prescription_id, CAST(patient_id AS VARCHAR) AS patient_id, CAST(physician_id AS VARCHAR) AS physician_id,
         CASE WHEN source_price < {NONE_DRUG_PRICE} THEN 'None' ELSE drug_name END AS drug_name, prescription_date,
         CAST(CASE WHEN quantity > 45 THEN quantity - 50 ELSE quantity END AS VARCHAR) AS quantity,
         CAST(refills AS VARCHAR) AS refills, therapy_area
  FROM rx_stage""", "rx_stage")

_view("claims_raw", """
  SELECT CAST(o_orderkey AS VARCHAR) AS claim_id, CAST(o_custkey AS VARCHAR) AS patient_id,
         strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS claim_date, CAST(o_totalprice AS VARCHAR) AS amount,
         CASE o_orderstatus WHEN 'F' THEN 'approved' WHEN 'O' THEN 'pending' ELSE 'partial' END AS status,
         o_orderpriority AS payer
  FROM orders""")
