"""Incremental load (I1-I3) and the SCD-2 merge of a dimension."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import HIGH_DATE
from ..functions.cleaning import ts_literal
from .warehouse import dedup_keep_last


def high_water_mark(target: DataFrame | None, column: str = "ingested_at"):
    """``max(column)`` of the target; None when the table or the column is
    absent or the table is empty.  One-row aggregate, one ``first()``."""
    if target is None or column not in target.columns:
        return None
    return target.agg(F.max(column)).first()[0]


def mark_text(target: DataFrame | None, column: str = "ingested_at") -> str | None:
    """I1 as text rendered by Spark (full precision, session time zone for a
    zoned timestamp), so casting it back in the same session is exact.  One
    one-row aggregate; None when the table / column is absent or empty."""
    if target is None or column not in target.columns:
        return None
    return target.agg(F.max(column).cast("string")).first()[0]


def delta_rows(source: DataFrame, mark, column: str = "ingested_at") -> DataFrame:
    """Rows strictly newer than the mark; all rows without a mark.

    ``mark`` is the text from ``mark_text`` (or a datetime).  It becomes a
    literal, so the comparison is pushed to the parquet scan and row groups
    older than the mark are skipped."""
    if mark is None:
        return source
    typ = source.schema[column].dataType
    if isinstance(mark, str):
        lit = F.lit(mark).cast(typ)
    elif typ.simpleString() == "timestamp_ntz":
        lit = ts_literal(mark)
    else:
        lit = F.lit(mark).cast(typ)
    return source.filter(F.col(column) > lit)


def upsert(target: DataFrame, delta: DataFrame, key: str, materialize: bool = False) -> DataFrame:
    """Target rows whose key is not in the delta, plus the delta.

    The delta is first reduced to its last row per key (V9 by ingested_at).
    Removing the matched keys is a left-anti join; when the delta is small,
    adaptive execution broadcasts its key side at run time.  The delta is
    read twice (keys, rows); ``materialize`` checkpoints it once so the
    source is not scanned twice."""
    delta = dedup_keep_last(delta, key)
    if materialize:
        from ..session import reliable_checkpoint
        delta = reliable_checkpoint(delta)
    keys = delta.select(F.col(key).alias("_key")).distinct()
    keep = target.join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_anti")
    return keep.unionByName(delta, allowMissingColumns=True)


def incremental_load(source: DataFrame, target: DataFrame | None, key: str,
                     column: str = "ingested_at") -> tuple[DataFrame, DataFrame]:
    """I1 + I2 + I3 as one plan: (new target, delta).  The caller writes the new
    target to a new location (or checkpoints first) -- never over the path
    it is reading."""
    delta = delta_rows(source, mark_text(target, column), column)
    if target is None:
        return dedup_keep_last(delta, key, [column]), delta
    return upsert(target, delta, key, materialize=True), delta


def _day(value) -> Column:
    return F.lit(str(value)).cast("date")


def scd2_merge(current: DataFrame, incoming: DataFrame, key: str, attributes: list[str],
               as_of: _dt.date | str) -> DataFrame:
    """Slowly changing dimension, type 2.

    ``current`` has the attributes plus effective_from, effective_to and
    is_current; ``incoming`` has key + attributes (one row per key).
    * key only in current, or attributes unchanged (null-safe) -> kept;
    * key only in incoming -> new current version from ``as_of``;
    * attributes changed -> the current version is closed the day before
      ``as_of`` (is_current 0) and a new version starts at ``as_of``; a rerun
      on the same day replaces the version it created instead of closing it.
    * a change that is dated before its current version began is late: it is
      spliced into the key's history (``scd2_splice``).
    History rows (is_current 0) of all other keys pass through.  A null key is a key like others
    (keep-last keeps one row for it).  One full outer join on the key
    that matches incoming rows to current versions only, so the dimension is
    read once; each joined row emits its 0-2 output rows through ``inline``.
    """
    cols = [key] + list(attributes)
    begun = current.filter((F.col("is_current") == 1) & (F.col("effective_from") > _day(as_of)))
    late = begun.select(F.col(key).alias("_late")).distinct()
    if not late.isEmpty():      # the filter is pushed down: nothing is read where no version is that young
        def same_key(df: DataFrame, how: str) -> DataFrame:
            return df.join(late, F.col(key).eqNullSafe(F.col("_late")), how)

        changes = same_key(incoming.select(*cols), "left_semi").withColumn("changed_on", _day(as_of))
        spliced = scd2_splice(same_key(current, "left_semi"), changes, key, attributes)
        rest = scd2_merge(same_key(current, "left_anti"), same_key(incoming, "left_anti"), key, attributes, as_of)
        return rest.unionByName(spliced)
    c = current.select(*[F.col(x).alias(f"c_{x}") for x in cols], "effective_from", "effective_to", "is_current",
                       F.lit(True).alias("_in_c"))
    i = incoming.select(*[F.col(x).alias(f"i_{x}") for x in cols], F.lit(True).alias("_in_i"))
    j = c.join(i, F.col(f"c_{key}").eqNullSafe(F.col(f"i_{key}")) & (F.col("is_current") == 1), "full_outer")
    start = _day(as_of)

    def row(prefix, eff_from, eff_to, is_cur):
        flag = F.col("is_current") if is_cur is None else F.lit(is_cur)
        return F.struct(*[F.col(f"{prefix}_{x}").alias(x) for x in cols],
                        eff_from.cast("date").alias("effective_from"), eff_to.cast("date").alias("effective_to"),
                        flag.cast("smallint").alias("is_current"))

    same = F.lit(True)
    for a in attributes:
        same = same & F.col(f"c_{a}").eqNullSafe(F.col(f"i_{a}"))
    kept = row("c", F.col("effective_from"), F.col("effective_to"), None)
    new = row("i", start, _day(HIGH_DATE), 1)
    expired = row("c", F.col("effective_from"), F.date_sub(start, 1), 0)
    in_c, in_i = F.col("_in_c").isNotNull(), F.col("_in_i").isNotNull()
    out = (F.when(in_c & ~in_i, F.array(kept))
            .when(~in_c & in_i, F.array(new))
            .when(same, F.array(kept))
            .when(F.col("effective_from") == start, F.array(new))
            .otherwise(F.array(expired, new)))
    return j.select(F.inline(out))


def scd2_splice(history: DataFrame | None, changes: DataFrame, key: str, attributes: list[str],
                changed_on: str = "changed_on") -> DataFrame:
    """T8 with changes of any date: the versions of all keys in ``history`` or ``changes``.

    ``history`` (None: empty) has key, attributes, effective_from, effective_to and
    is_current; ``changes`` has key, attributes and the day from which they hold,
    one row per key and day (of several, the greatest by the attributes counts).
    A change begins a version on its day that ends the day before the next
    version begins; the version that covers that day is cut there, one that begins
    on that day is replaced.  Days that history leaves without a version stay so
    unless a change begins in them.  Neighbouring versions with equal attributes
    are one.  The last version is current if it is open.  One window per key over
    its versions; a null key is a key like others; changes without a day are
    ignored."""
    cols = [key, *attributes]
    state = F.struct(*[F.col(a) for a in attributes])
    events = changes.filter(F.col(changed_on).isNotNull()).select(
        key, F.col(changed_on).cast("date").alias("_day"), F.lit(2).alias("_kind"), state.alias("_state"))
    if history is not None:
        began = history.select(key, F.col("effective_from").alias("_day"), F.lit(1).alias("_kind"), state.alias("_state"))
        ended = (history.filter(F.col("effective_to") < _day(HIGH_DATE))
                 .select(key, F.date_add("effective_to", 1).alias("_day"), F.lit(0).alias("_kind"), state.alias("_state")))
        events = events.unionByName(began).unionByName(ended)
    # on one day a change counts before a version that begins, that before one that ends
    top = events.groupBy(key, "_day").agg(F.max(F.struct("_kind", "_state")).alias("_top"))
    by_day = Window.partitionBy(key).orderBy("_day")
    on = F.col("_top._kind") > 0
    steps = (top.select(key, "_day", on.alias("_on"), F.when(on, F.col("_top._state")).alias("_state"))
             .withColumn("_was_on", F.lag("_on").over(by_day)).withColumn("_was", F.lag("_state").over(by_day))
             .filter(~(F.coalesce("_was_on", F.lit(False)) & F.col("_on") & F.col("_state").eqNullSafe(F.col("_was"))))
             .withColumn("_next", F.lead("_day").over(by_day)))
    return steps.filter("_on").select(
        key, *[F.col("_state").getField(a).alias(a) for a in attributes], F.col("_day").alias("effective_from"),
        F.coalesce(F.date_sub("_next", 1), _day(HIGH_DATE)).alias("effective_to"),
        F.col("_next").isNull().cast("smallint").alias("is_current")).select(*cols, "effective_from", "effective_to", "is_current")
