"""DuckDB SQL for data-quality check rows (oracle side of Q1-Q9)."""

from __future__ import annotations

from ..operators.quality import Check


def _pct(score: str) -> str:
    return f"printf('%.1f%%', round_even({score} * 100.0, 1))"


def _fmt1(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR isnan({x}) THEN 'nan' ELSE printf('%.1f', round_even({x}, 1)) END"


def _head(c: Check) -> str:
    col = "NULL" if c.column is None else f"'{c.column}'"
    return (f"'{c.name}' AS name, '{c.check_type}' AS check_type, '{c.table}' AS \"table\", "
            f"CAST({col} AS VARCHAR) AS \"column\", CAST({float(c.threshold)} AS DOUBLE) AS threshold")


def check_sql(c: Check, view: dict[str, str]) -> str:
    t = view[c.table]
    if c.check_type in ("completeness", "uniqueness"):
        agg = f"COUNT({c.column})" if c.check_type == "completeness" else f"COUNT(DISTINCT {c.column})"
        word = "non-null" if c.check_type == "completeness" else "unique"
        empty = "'Table is empty'" if c.check_type == "completeness" else "''"
        return f"""SELECT {_head(c)},
            CASE WHEN total = 0 THEN false ELSE k / total >= {c.threshold} END AS passed,
            ROUND(CASE WHEN total = 0 THEN 0.0 ELSE k / total END, 6) AS score,
            CASE WHEN total = 0 THEN {empty}
                 ELSE printf('%d/%d {word} (%s)', k, total, {_pct('k / total')}) END AS details
          FROM (SELECT COUNT(*) AS total, {agg} AS k FROM {t})"""
    if c.check_type == "row_count":
        return f"""SELECT {_head(c)}, total >= {c.min_rows} AS passed,
            CAST(CASE WHEN total >= {c.min_rows} THEN 1.0 ELSE 0.0 END AS DOUBLE) AS score,
            printf('%d rows (need at least {c.min_rows})', total) AS details
          FROM (SELECT COUNT(*) AS total FROM {t})"""
    if c.check_type == "distribution":
        lo = f"COUNT(*) FILTER (WHERE v < {c.min_val})" if c.min_val is not None else "0"
        hi = f"COUNT(*) FILTER (WHERE v > {c.max_val})" if c.max_val is not None else "0"
        return f"""SELECT {_head(c)},
            CASE WHEN n = 0 THEN false ELSE 1.0 - (lo + hi) / n >= {c.threshold} END AS passed,
            ROUND(CASE WHEN n = 0 THEN 0.0 ELSE 1.0 - (lo + hi) / n END, 6) AS score,
            CASE WHEN n = 0 THEN 'No numeric values'
                 ELSE printf('mean=%s, std=%s, %d outliers', {_fmt1('mean')}, {_fmt1('std')}, lo + hi) END
              AS details
          FROM (SELECT COUNT(v) AS n, {lo} AS lo, {hi} AS hi, AVG(v) AS mean, STDDEV_SAMP(v) AS std
                FROM (SELECT CASE WHEN isnan(x) THEN NULL ELSE x END AS v
                      FROM (SELECT TRY_CAST(CAST({c.column} AS VARCHAR) AS DOUBLE) AS x FROM {t})))"""
    if c.check_type == "referential_integrity":
        p = view[c.parent_table]
        return f"""SELECT {_head(c)},
            (CASE WHEN kids > 0 THEN 1.0 - orph / kids ELSE 1.0 END) >= {c.threshold} AS passed,
            ROUND(CASE WHEN kids > 0 THEN 1.0 - orph / kids ELSE 1.0 END, 6) AS score,
            printf('%d orphan values out of %d', orph, kids) AS details
          FROM (SELECT (SELECT COUNT(DISTINCT {c.column}) FROM {t}) AS kids,
                       (SELECT COUNT(*) FROM (SELECT DISTINCT {c.column} FROM {t} WHERE {c.column} IS NOT NULL
                                              EXCEPT SELECT {c.parent_column} FROM {p})) AS orph)"""
    raise ValueError(c.check_type)


def suite_sql(checks: list[Check], view: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(check_sql(c, view) for c in checks)
