"""Record validation (V1-V8): the dataset rules compiled into Column expressions.

The reference validates one dict at a time; here every rule is a predicate
evaluated in the same scan, and the error messages of a row are gathered
with ``array_compact(array(when(rule, msg), ...))``.  Messages are listed in
a fixed order: missing required columns first, then the declared properties
in declaration order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import null_normalised, to_date_strict, to_double, to_int_trunc
from ..schemas import RULES, STAGING_TYPES

ERROR_COL = "_validation_error"


def _enum_text(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _num_text(c: Column) -> Column:
    """Render a coerced number the way Python prints it (3 for ints, 3.5 for floats)."""
    return F.when(c == F.floor(c), c.cast("long").cast("string")).otherwise(c.cast("string"))


def _raw_col(name: str) -> str:
    return f"__raw_{name}"


def _num_col(name: str) -> str:
    return f"__num_{name}"


def _prepare(df: DataFrame, rule: dict) -> DataFrame:
    """Normalised text (V1) and coerced number (V2) of each declared column,
    computed once so every rule reads a column instead of re-deriving it."""
    cols = {}
    for name, typ, _extra in rule["properties"]:
        if name not in df.columns:
            continue
        raw = null_normalised(F.col(name).cast("string"))
        cols[_raw_col(name)] = raw
        if typ == "integer":
            cols[_num_col(name)] = to_int_trunc(raw).cast("double")
        elif typ == "number":
            cols[_num_col(name)] = to_double(raw)
    return df.withColumns(cols) if cols else df


def property_errors(col: str, typ: str, extra: dict, present: bool) -> list[Column]:
    """Messages for one declared property (V1-V3, V5-V7); null where the rule
    holds.  Reads the columns made by ``_prepare``."""
    if not present:
        return []
    raw = F.col(_raw_col(col))
    quoted = F.concat(F.lit("'"), raw, F.lit("'"))
    out = [F.when(raw.isNull(), F.lit(f"None is not of type '{typ}'"))]
    num = F.col(_num_col(col)) if typ in ("integer", "number") else None
    if num is not None:
        out.append(F.when(raw.isNotNull() & num.isNull(), F.concat(quoted, F.lit(f" is not of type '{typ}'"))))
    if "pattern" in extra:
        out.append(F.when(raw.isNotNull() & ~raw.rlike(extra["pattern"]),
                          F.concat(quoted, F.lit(f" does not match '{extra['pattern']}'"))))
    if "enum" in extra:
        out.append(F.when(raw.isNotNull() & ~raw.isin(*extra["enum"]),
                          F.concat(quoted, F.lit(f" is not one of {_enum_text(extra['enum'])}"))))
    if "minimum" in extra and num is not None:
        out.append(F.when(num < F.lit(extra["minimum"]),
                          F.concat(_num_text(num), F.lit(f" is less than the minimum of {extra['minimum']}"))))
    return out


def validation_errors(df: DataFrame, dataset: str, rules: dict | None = None,
                      corrupt: str | None = "_corrupt") -> Column:
    """Array of error messages of a raw (all-text) row prepared by ``_prepare``; empty when valid."""
    rule = (rules or RULES)[dataset]
    cols = set(df.columns)
    msgs: list[Column] = []
    for req in rule["required"]:                                   # V4
        if req not in cols:
            msgs.append(F.lit(f"'{req}' is a required property"))
    if corrupt and corrupt in cols:                                # malformed line (short / long)
        msgs.append(F.when(F.col(corrupt).isNotNull(), F.lit("malformed CSV record")))
    for name, typ, extra in rule["properties"]:                    # V1-V3, V5-V7
        msgs += property_errors(name, typ, extra, name in cols)
    return F.array_compact(F.array(*msgs)) if msgs else F.array().cast("array<string>")


def validate(df: DataFrame, dataset: str, rules: dict | None = None,
             corrupt: str | None = "_corrupt") -> DataFrame:
    """V8 (marking): add ``_validation_error`` -- null for a valid row, else
    the messages joined by '; '."""
    rule = (rules or RULES)[dataset]
    prepared = _prepare(df, rule)
    errs = validation_errors(prepared, dataset, rules, corrupt)
    helpers = [c for c in prepared.columns if c.startswith("__raw_") or c.startswith("__num_")]
    return (prepared.withColumn("_errs", errs)
            .withColumn(ERROR_COL, F.when(F.size("_errs") > 0, F.array_join("_errs", "; ")))
            .drop("_errs", *helpers))


def coerce(df: DataFrame, dataset: str, rules: dict | None = None) -> DataFrame:
    """Loaded values: V1 null tokens, integers truncated, numbers as
    DECIMAL(10,2), dates parsed; the staging column order and types."""
    rule = (rules or RULES)[dataset]
    types = STAGING_TYPES.get(dataset, {})
    out = []
    for name, typ, _extra in rule["properties"]:
        raw = null_normalised(F.col(name).cast("string")) if name in df.columns else F.lit(None).cast("string")
        t = types.get(name)
        if typ == "integer":
            v = to_int_trunc(raw)
        elif typ == "number":
            v = to_double(raw).try_cast(t.simpleString() if t is not None else "double")
        elif t is not None and t.simpleString() == "date":
            v = to_date_strict(raw)
        else:
            v = raw
        out.append(v.alias(name))
    extra_cols = [c for c in ("_row_number", "_file") if c in df.columns]
    return df.select(*out, *extra_cols)


def split(validated: DataFrame, dataset: str | None = None) -> tuple[DataFrame, DataFrame]:
    """V8 (split): (valid, invalid).  Valid rows are coerced to staging types
    when ``dataset`` is given; invalid rows keep their raw text, the error and
    the row number."""
    valid = validated.filter(F.col(ERROR_COL).isNull()).drop(ERROR_COL)
    if dataset is not None:
        valid = coerce(valid, dataset)
    invalid = validated.filter(F.col(ERROR_COL).isNotNull())
    return valid, invalid
