"""Data quality kept up to date load by load (Q1-Q6).

``run`` profiles the staged rows that are newer than the marks of the last commit
and nothing else.  What a profile cannot hold, the keys seen so far, lies in bucketed
tables of distinct values; a load reads and writes the buckets of its own keys only.
Profiles, keys and marks become visible by one commit, so a load that dies and runs
again counts once.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import incremental, quality_profile
from ..operators.quality import Check, default_suite
from ..session import drop_checkpoint, reliable_checkpoint
from ..sources.buckets import BucketStore, Commit

PROFILES = "dq_profile"


def _key_table(table: str, column: str) -> str:
    return f"dq_keys_{table}_{column}"


def _key_columns(table: str, checks: list[Check]) -> list[str]:
    """The columns of ``table`` whose distinct values the checks need."""
    need = [c.column for c in checks if c.table == table and c.check_type in ("uniqueness", "referential_integrity")]
    need += [c.parent_column for c in checks if c.parent_table == table]
    return list(dict.fromkeys(need))


def _known(commit: Commit, name: str, keys: DataFrame) -> DataFrame:
    """The stored keys in the buckets of ``keys`` (one column, ``key``)."""
    if not commit.has(name):
        return keys.limit(0)
    known = commit.read(name, commit.touched(name, keys, "key"))
    if known.schema["key"].dataType != keys.schema["key"].dataType:
        raise ValueError(f"{name} holds {known.schema['key'].dataType.simpleString()}, "
                         f"the load brings {keys.schema['key'].dataType.simpleString()}")
    return known


def run(store: BucketStore, tables: Mapping[str, DataFrame], checks: Iterable[Check] | None = None,
        column: str = "ingested_at", keep: int = 2) -> int:
    """Profile all that is new in ``tables`` (append-only, stamped by ``column``; rows
    without a stamp are left) and commit.  Keys of a referential check must have one type
    in both tables; a parent table without the column has no keys.  Returns the number of the commit."""
    measures = {quality_profile.measured(c): c for c in (checks if checks is not None else default_suite())}
    checks = list(measures.values())      # checks that differ in their limits only are one measure
    commit = store.begin()
    fresh = {t: reliable_checkpoint(incremental.delta_rows(rows.filter(F.col(column).isNotNull()), commit.marks.get(f"dq_{t}"), column))
             for t, rows in tables.items()}
    new: dict[tuple[str, str], DataFrame] = {}
    for table, rows in fresh.items():
        for col in _key_columns(table, checks):
            if col in rows.columns:
                keys = reliable_checkpoint(rows.select(F.col(col).alias("key")).filter("key is not null").distinct())
                new[table, col] = reliable_checkpoint(keys.join(_known(commit, _key_table(table, col), keys), "key", "left_anti"))
                drop_checkpoint(keys)
    integrity = [c for c in checks if c.check_type == "referential_integrity"]
    orphans = dict.fromkeys(integrity, 0)
    for c in integrity:       # parents that come now take orphans of earlier loads away
        parents = new.get((c.parent_table, c.parent_column))
        if parents is not None:
            children = _known(commit, _key_table(c.table, c.column), parents)
            orphans[c] -= parents.join(children, "key", "left_semi").count()
    for (table, col), keys in new.items():
        commit.upsert(_key_table(table, col), keys, "key")
    changes = []
    for c in integrity:       # children that come now, against all parents so far
        children = new.get((c.table, c.column))
        if children is not None:
            parents = _known(commit, _key_table(c.parent_table, c.parent_column), children)
            orphans[c] += children.join(parents, "key", "left_anti").count()
        if children is not None or orphans[c]:
            changes.append((c, children.count() if children is not None else 0, orphans[c]))
    changes += [(c, new[c.table, c.column].count(), 0) for c in checks
                if c.check_type == "uniqueness" and (c.table, c.column) in new]
    profiles = quality_profile.entries(store.spark, changes)
    for table, rows in fresh.items():
        profiles = profiles.unionByName(quality_profile.profile_load(rows, [c for c in checks if c.table == table], table))
        commit.marks[f"dq_{table}"] = incremental.mark_text(rows, column) or commit.marks.get(f"dq_{table}")
    commit.append(PROFILES, profiles.coalesce(1), quality_profile.merge)    # at most a row a check and table
    number = commit.publish()
    for table in (*fresh.values(), *new.values()):
        drop_checkpoint(table)
    store.vacuum(keep)
    return number


def suite(store: BucketStore, checks: Iterable[Check] | None = None) -> DataFrame:
    """Q6 over all loads, from their profiles."""
    return quality_profile.run_checks(store.read(PROFILES), checks)
