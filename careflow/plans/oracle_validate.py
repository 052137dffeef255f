"""DuckDB SQL for record validation (oracle side of V1-V8)."""

from __future__ import annotations

from ..schemas import RULES, STAGING_TYPES


def _raw(col: str) -> str:
    return f"(CASE WHEN CAST({col} AS VARCHAR) IN ('', 'None') THEN NULL ELSE CAST({col} AS VARCHAR) END)"


def _int(raw: str) -> str:
    return (f"(CASE WHEN abs(TRY_CAST({raw} AS DOUBLE)) < 2147483648.0 "
            f"THEN CAST(trunc(TRY_CAST({raw} AS DOUBLE)) AS INTEGER) END)")


def _num_text(x: str) -> str:
    return f"(CASE WHEN {x} = floor({x}) THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) ELSE CAST({x} AS VARCHAR) END)"


def errors_sql(dataset: str) -> str:
    msgs = []
    for name, typ, extra in RULES[dataset]["properties"]:
        raw = _raw(name)
        q = f"'''' || {raw} || ''''"
        msgs.append(f"CASE WHEN {raw} IS NULL THEN 'None is not of type ''{typ}''' END")
        num = None
        if typ == "integer":
            num = f"CAST({_int(raw)} AS DOUBLE)"
        elif typ == "number":
            num = f"TRY_CAST({raw} AS DOUBLE)"
        if num:
            msgs.append(f"CASE WHEN {raw} IS NOT NULL AND {num} IS NULL THEN {q} || ' is not of type ''{typ}''' END")
        if "pattern" in extra:
            msgs.append(f"CASE WHEN {raw} IS NOT NULL AND NOT regexp_matches({raw}, '{extra['pattern']}') "
                        f"THEN {q} || ' does not match ''{extra['pattern']}''' END")
        if "enum" in extra:
            vals = ", ".join(f"'{v}'" for v in extra["enum"])
            text = "[" + ", ".join(f"''{v}''" for v in extra["enum"]) + "]"
            msgs.append(f"CASE WHEN {raw} IS NOT NULL AND {raw} NOT IN ({vals}) "
                        f"THEN {q} || ' is not one of {text}' END")
        if "minimum" in extra and num:
            msgs.append(f"CASE WHEN {num} < {extra['minimum']} THEN {_num_text(num)} || "
                        f"' is less than the minimum of {extra['minimum']}' END")
    lst = f"list_filter([{', '.join(msgs)}], lambda x: x IS NOT NULL)"
    return f"CASE WHEN len({lst}) > 0 THEN array_to_string({lst}, '; ') END"


def validated_sql(dataset: str, source: str) -> str:
    return f"SELECT *, {errors_sql(dataset)} AS _validation_error FROM {source}"


def coerced_select(dataset: str) -> str:
    types = STAGING_TYPES.get(dataset, {})
    out = []
    for name, typ, _extra in RULES[dataset]["properties"]:
        raw = _raw(name)
        t = types.get(name)
        if typ == "integer":
            out.append(f"{_int(raw)} AS {name}")
        elif typ == "number":
            out.append(f"TRY_CAST(TRY_CAST({raw} AS DOUBLE) AS {t.simpleString().upper() if t else 'DOUBLE'}) AS {name}")
        elif t is not None and t.simpleString() == "date":
            out.append(f"CAST(try_strptime({raw}, '%Y-%m-%d') AS DATE) AS {name}")
        else:
            out.append(f"{raw} AS {name}")
    return ", ".join(out)
