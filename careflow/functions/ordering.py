"""Order-dependent row operations that stay correct when one key is huge.

A plain ``Window.partitionBy(patient)`` sends every row of a patient to one
task.  If one patient (or one prescription id) holds a third of all rows that
task holds a third of the data.  The helpers here split the work:

* ``keep_last`` is an aggregation (``max`` of a struct), so map-side partial
  aggregation collapses a hot key to one row per map task before the shuffle.
* ``sequence_number`` and ``previous_value`` count the rows of every group
  first (one column, combined on the map side).  Ordinary groups take one
  window: one shuffle of their rows.  The rows of groups with more than
  ``hot_rows`` rows are range-partitioned on the full ordering key and each sorted
  partition is cut into ordered slices; a window numbers each slice, and a
  running sum (or a lag) over one row per slice carries the state across.
  The set of hot groups and the slices are written once, so every use and
  every retried task sees the same ones.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import reliable_checkpoint

# Null days sort after every real day; they are bucketed under this key.
NULL_DAY = "9999-12-31"


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def keep_last(df: DataFrame, key, order: Sequence[str], placed: bool = False) -> DataFrame:
    """One row per key value: the greatest row by ``order`` then all other columns.

    Null key values form one group (as ``groupBy`` does).  Within ``order`` a
    null sorts lowest, so a non-null value wins.  Output columns and order are
    those of ``df``.  ``placed``: the rows of a key lie in one task already (a
    ``dealt_checkpoint`` by ``key``), so nothing is left to combine before a shuffle:
    the first row of every key is taken from one sort, rows are not packed and compared.
    """
    keys = _cols(key)
    order = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    if placed and order + rest:
        last = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order + rest])
        return df.withColumn("_place", F.row_number().over(last)).filter("_place = 1").select(*df.columns)
    packed = F.struct(*[F.col(c) for c in order + rest])
    return (df.groupBy(*keys)
              .agg(F.max(packed).alias("_last"))
              .select(*[F.col(k) for k in keys],
                      *[F.col("_last").getField(c).alias(c) for c in order + rest])
              .select(*df.columns))


def _day_key(day: str) -> Column:
    return F.coalesce(F.col(day), F.lit(NULL_DAY).cast("date"))


# A group with more rows than this is cut into slices of about half as many.
HOT_ROWS = 2_000_000


def _hot_groups(df: DataFrame, group: str, hot_rows: int) -> tuple[DataFrame, int]:
    """Groups with more than ``hot_rows`` rows (written once), and the rows they hold."""
    hot = reliable_checkpoint(df.groupBy(group).agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") > hot_rows))
    return hot, hot.agg(F.coalesce(F.sum("_c"), F.lit(0))).first()[0]


#: Rows of a task that cuts slices, at least: small slices share a range partition.
SLICED_ROWS = 250_000


def _sliced(df: DataFrame, group: str, order: list, rows: int, hot_rows: int) -> DataFrame:
    """Rows with ``_sl``, the number of an ordered slice of at most half of ``hot_rows``
    rows.  Spark's sampled range bounds on (group, order) deal the rows out; a
    partition is sorted and cut every so many rows, so the number of partitions
    follows the rows, not the slices."""
    size = max(1, hot_rows // 2)
    n = max(2, math.ceil(rows / max(size, SLICED_ROWS)))
    at = F.monotonically_increasing_id()
    place = at.bitwiseAND((1 << 33) - 1)     # within the partition
    dealt = df.repartitionByRange(n, F.col(group), *order).sortWithinPartitions(F.col(group), *order)
    return reliable_checkpoint(dealt.withColumn("_sl", at - F.pmod(place, F.lit(size))))


def sequence_number(df: DataFrame, group: str, day: str, tie: Sequence, out: str = "sequence_num",
                    hot_rows: int = HOT_ROWS) -> DataFrame:
    """1-based position of each row inside its group, ordered by day (nulls
    last) then ``tie``.  Rows whose group is null get a null position."""
    order = [F.col("_dk"), *tie]
    keyed = df.withColumn("_dk", _day_key(day))
    no_group = keyed.filter(F.col(group).isNull()).withColumn(out, F.lit(None).cast("int")).drop("_dk")
    base = keyed.filter(F.col(group).isNotNull())
    hot, n_hot = _hot_groups(df.filter(F.col(group).isNotNull()), group, hot_rows)
    rows = base.join(hot.select(group), group, "left_anti").withColumn(
        out, F.row_number().over(Window.partitionBy(group).orderBy(*order)).cast("int"))
    if n_hot:  # otherwise no row is left for the slices
        heavy = _sliced(base.join(hot.select(group), group, "left_semi"), group, order, n_hot, hot_rows)
        before = heavy.groupBy(group, "_sl").agg(F.count(F.lit(1)).alias("_n")).withColumn(
            "_off", F.sum("_n").over(Window.partitionBy(group).orderBy("_sl")) - F.col("_n")).drop("_n")
        numbered = heavy.withColumn("_rn", F.row_number().over(Window.partitionBy(group, "_sl").orderBy(*order)))
        rows = rows.unionByName(numbered.join(before, [group, "_sl"])
                                .withColumn(out, (F.col("_off") + F.col("_rn")).cast("int")).drop("_sl", "_rn", "_off"))
    rows = rows.drop("_dk")
    return rows.unionByName(no_group.select(*rows.columns))


def previous_value(df: DataFrame, group: str, day: str, tie: Sequence[str],
                   value: str, out: str = "previous", has_out: str = "has_previous",
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """Value of ``value`` on the preceding row of the same group, ordered by
    day then ``tie``; ``has_out`` says whether such a row exists (the previous
    value itself may be null).  Rows with a null group are dropped."""
    order = [F.col("_dk"), *[F.col(c) for c in tie]]
    known = df.filter(F.col(group).isNotNull())
    base = known.withColumn("_dk", _day_key(day))
    hot, n_hot = _hot_groups(known, group, hot_rows)
    w = Window.partitionBy(group).orderBy(*order)
    rows = (base.join(hot.select(group), group, "left_anti")
            .withColumn(out, F.lag(value).over(w)).withColumn(has_out, F.row_number().over(w) > 1))
    if n_hot:
        heavy = _sliced(base.join(hot.select(group), group, "left_semi"), group, order, n_hot, hot_rows)
        w = Window.partitionBy(group, "_sl").orderBy(*order)
        in_slice = (heavy.withColumn("_rn", F.row_number().over(w)).withColumn("_lag", F.lag(value).over(w))
                    .withColumn("_is_last", F.lead(F.lit(1)).over(w).isNull()))
        slices = Window.partitionBy(group).orderBy("_sl")
        ends = (in_slice.filter("_is_last").select(group, "_sl", F.col(value).alias("_end"))
                .withColumn("_before", F.lag("_end").over(slices))
                .withColumn("_some", F.row_number().over(slices) > 1).drop("_end"))
        first = F.col("_rn") == 1
        rows = rows.unionByName(
            in_slice.join(ends, [group, "_sl"])
            .withColumn(out, F.when(first, F.col("_before")).otherwise(F.col("_lag")))
            .withColumn(has_out, F.when(first, F.col("_some")).otherwise(F.lit(True)))
            .drop("_sl", "_rn", "_lag", "_is_last", "_before", "_some"))
    return rows.drop("_dk")
