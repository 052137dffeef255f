"""Column-level cleaning expressions (all built-in, inside whole-stage codegen)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text that counts as "no value" in a raw record.
NULL_TOKENS = ("", "None")
DATE_FORMAT = "yyyy-MM-dd"


def ts_literal(value) -> Column:
    """A wall-clock timestamp literal (TIMESTAMP WITHOUT TIME ZONE): the same
    value whatever the session or process time zone."""
    text = value.isoformat(sep=" ") if hasattr(value, "isoformat") else str(value)
    return F.lit(text).cast("timestamp_ntz")


def null_normalised(c: Column) -> Column:
    """V1: missing, '' and 'None' become null."""
    return F.when(c.isin(*NULL_TOKENS), F.lit(None)).otherwise(c)


def to_double(c: Column) -> Column:
    """V2 'number': text -> double, null when it does not parse."""
    return c.try_cast("double")


def to_int_trunc(c: Column) -> Column:
    """V2 'integer': int(float(x)) -- parse as double, truncate toward zero.

    Infinite / NaN / out-of-range values give null (the reference crashed).
    """
    d = c.try_cast("double")
    ok = d.isNotNull() & ~F.isnan(d) & (F.abs(d) < F.lit(2147483648.0))
    return F.when(ok, d.cast("long").cast("int"))


#: Text that ``DATE_FORMAT`` reads as the cast to DATE does (year 0 is none to the former), and text
#: that is in every date of it, years of more digits included.
_PLAIN_DATE, _SOME_DATE = r"\A(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}\z", "[0-9]{4}-[0-9]{2}-[0-9]{2}"


def to_date_strict(c: Column, fmt: str = DATE_FORMAT) -> Column:
    """V10 date parse: null when the text is not a date in ``fmt``.  The parser by pattern is slow
    and raises an exception inside for every bad text, so plain dates are cast, and text that
    holds no date does not reach it."""
    text = c.cast("string")
    if fmt != DATE_FORMAT:
        return F.try_to_date(text, fmt)
    return F.when(text.rlike(_PLAIN_DATE), text.try_cast("date")).when(text.rlike(_SOME_DATE), F.try_to_date(text, fmt))


def normalize_dates(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Parse the listed columns to DATE and drop rows that do not parse.
    Absent columns are skipped; DATE columns are kept as they are."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    keep = F.lit(True)
    for c in columns:
        if c not in types:
            continue
        t = types[c]
        if isinstance(t, T.DateType):
            parsed = F.col(c)
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            parsed = F.to_date(F.col(c))
        else:
            parsed = to_date_strict(F.col(c))
        df = df.withColumn(c, parsed)
        keep = keep & F.col(c).isNotNull()
    return df.filter(keep)


def to_int_or_zero(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Numeric coerce, bad or null -> 0, truncated to INT."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    for c in columns:
        if c not in types:
            continue
        if isinstance(types[c], (T.IntegerType, T.ShortType, T.ByteType)):
            expr = F.col(c).cast("int")
        else:
            expr = to_int_trunc(F.col(c).cast("string"))
        df = df.withColumn(c, F.coalesce(expr, F.lit(0)))
    return df


def with_constants(df: DataFrame, values: dict) -> DataFrame:
    """Add constant columns."""
    return df.withColumns({k: (v if isinstance(v, Column) else F.lit(v)) for k, v in values.items()})


def drop_if_present(df: DataFrame, *columns: str) -> DataFrame:
    """Drop columns that exist; absent ones are ignored."""
    return df.drop(*[c for c in columns if c in df.columns])


def filter_equal(df: DataFrame, **conditions) -> DataFrame:
    """Equality filter for every parameter that is given (not None)."""
    for col, value in conditions.items():
        if value is not None:
            df = df.filter(F.col(col) == F.lit(value))
    return df


def filter_at_least(df: DataFrame, column: str, threshold: float | None) -> DataFrame:
    """``column >= threshold``, applied only when threshold > 0."""
    if threshold is not None and threshold > 0:
        df = df.filter(F.col(column) >= F.lit(threshold))
    return df
