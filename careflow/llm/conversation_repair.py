"""Cheapest repair of damaged conversations (operator 13).

A conversation's rows, in order, become a short string of role initials and one
of faults.  Edits turn the roles into ``(s?(ua)+)?``: a row is kept, gets
another role or is deleted, and empty rows are put in.  The cheapest edits, and
of these the least string of edit initials, come from a dynamic program over
four states (nothing yet, after s, after u, after a).

The best edits of a state are a linked node that shares its prefix with others:
a node has its letter, depth, rolling hash of all letters up to it, and
ancestors 1, 2, 4, ... steps up.  Of two edits of equal cost the lesser is found
by the longest common prefix: ancestors whose hashes differ are skipped by
halving steps, and the prefix thought equal is verified letter by letter up to
a node that both share, so an accidental equal hash decides nothing.

A long conversation is cut into ordered slices.  Each slice is solved by itself
from every state to every state; the slices are then joined in order.  So no
task holds more than a slice of rows; what grows with a conversation is only
its string of edits, which is its result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from careflow.llm.common import materialise

#: A conversation with more rows is cut into slices of about half as many.
SLICE_ROWS = 20_000
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
#: States: nothing put out, after s, after u, after a.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ROLE = {USER: "user", ASSISTANT: "assistant"}
_FINAL = (NOTHING, ASSISTANT)
#: States that a kept initial may follow, and the state after it.
_KEPT = {"s": ((NOTHING,), SYSTEM), "u": ((NOTHING, SYSTEM, ASSISTANT), USER), "a": ((USER,), ASSISTANT)}
_NEXT = {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
#: Faults in a row's order of precedence.
BLANK, DUPLICATE, TRUNCATED, SOUND = "b", "d", "t", "-"
_MUST_GO = (BLANK, DUPLICATE)

_MODULUS = (1 << 61) - 1
_BASE = 1_000_003


class Edits:
    """Strings of letters as linked nodes; node 0 is the empty string."""

    def __init__(self, modulus: int = _MODULUS):
        self.modulus = modulus
        self.letter = [""]
        self.depth = [0]
        self.hash = [0]
        self.up: list[tuple[int, ...]] = [()]   # ancestors 1, 2, 4, ... steps up

    def add(self, node: int, letter: str) -> int:
        up = [node]
        k = 0
        while k < len(self.up[up[k]]):
            up.append(self.up[up[k]][k])
            k += 1
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * _BASE + ord(letter)) % self.modulus)
        self.up.append(tuple(up))
        return len(self.letter) - 1

    def ancestor(self, node: int, depth: int) -> int:
        """The prefix of ``depth`` letters."""
        steps, k = self.depth[node] - depth, 0
        while steps:
            if steps & 1:
                node = self.up[node][k]
            steps >>= 1
            k += 1
        return node

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def _same(self, a: int, b: int) -> bool:
        """Whether two nodes of one depth are equal strings (up to a shared node)."""
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether string a comes before string b."""
        if a == b:
            return False
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if x == y or (self.hash[x] == self.hash[y] and self._same(x, y)):
            return self.depth[a] < self.depth[b]
        if self.hash[x] == self.hash[y]:        # a collision at the end itself
            return self.text(a) < self.text(b)
        for k in range(len(self.up[x]) - 1, -1, -1):
            if k < len(self.up[x]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                x, y = self.up[x][k], self.up[y][k]
        if not self._same(self.up[x][0], self.up[y][0]):    # a collision on the way
            return self.text(a) < self.text(b)
        return self.letter[x] < self.letter[y]


def _better(edits: Edits, one: tuple[int, int] | None, two: tuple[int, int] | None) -> tuple[int, int] | None:
    """The better of two (cost, node); None is no way at all."""
    if one is None or two is None:
        return one or two
    if one[0] != two[0]:
        return one if one[0] < two[0] else two
    return two if edits.less(two[1], one[1]) else one


def slice_edits(initials: str, faults: str, start: int, modulus: int = _MODULUS) -> dict[int, tuple[int, str]]:
    """End state -> (cost, edit initials) of the best edits of these rows from ``start``.

    Two edits of equal cost that reach one state after the same rows are never
    prefixes of each other (the longer would have more inserts, so cost more);
    the lesser one therefore stays the lesser whatever follows."""
    edits = Edits(modulus)
    best: list[tuple[int, int] | None] = [None] * 4
    best[start] = (0, 0)

    def then(way: tuple[int, int] | None, letter: str, extra: int = 0) -> tuple[int, int] | None:
        return None if way is None else (way[0] + COST[letter] + extra, edits.add(way[1], letter))

    def with_inserts(ways: list) -> list:
        """At most two inserts make sense before a row: to u, then to a."""
        out = list(ways)
        for state in (NOTHING, SYSTEM, ASSISTANT):
            out[USER] = _better(edits, out[USER], then(ways[state], INSERT))
        out[ASSISTANT] = _better(edits, out[ASSISTANT], then(out[USER], INSERT))
        return out

    for initial, fault in zip(initials, faults, strict=True):
        ways = with_inserts(best)
        following = [then(way, DELETE) for way in ways]
        if fault not in _MUST_GO:
            extra = TRUNCATED_COST if fault == TRUNCATED else 0
            for state, way in enumerate(ways):
                after = _NEXT[state]
                following[after] = _better(edits, following[after], then(way, REROLE, extra))
                if initial in _KEPT and state in _KEPT[initial][0]:
                    after = _KEPT[initial][1]
                    following[after] = _better(edits, following[after], then(way, KEEP, extra))
        best = following
    return {state: (way[0], edits.text(way[1])) for state, way in enumerate(with_inserts(best)) if way is not None}


def join_slices(slices: list[dict[int, dict[int, tuple[int, str]]]]) -> tuple[int, list[tuple[int, int]]]:
    """Cost and (start, end) state of every slice of the best edits of the whole;
    ``slices``: start -> end -> (cost, edits) of each slice, in order."""
    ways: dict[int, tuple[int, tuple | None]] = {NOTHING: (0, None)}    # state -> cost, (way before, start, end, edits)

    def letters(link: tuple | None, until: tuple | None = None) -> str:
        parts = []
        while link is not until:
            parts.append(link[3])
            link = link[0]
        return "".join(reversed(parts))

    def lesser(one: tuple, two: tuple) -> bool:
        """Whether the edits of ``one`` come first; slices that both share are not read."""
        a, b = one, two
        while a is not b:
            a, b = a[0], b[0]
        return letters(one, a) < letters(two, a)

    for of_slice in slices:
        following: dict[int, tuple[int, tuple | None]] = {}
        for start, (cost, link) in ways.items():
            for end, (more, edits) in of_slice.get(start, {}).items():
                new = (cost + more, (link, start, end, edits))
                old = following.get(end)
                if old is None or new[0] < old[0] or (new[0] == old[0] and lesser(new[1], old[1])):
                    following[end] = new
        ways = following
    cost, link = min((ways[s] for s in _FINAL if s in ways), key=lambda w: (w[0], letters(w[1])))
    path = []
    while link is not None:
        path.append((link[1], link[2]))
        link = link[0]
    return cost, path[::-1]


def edited_rows(initials: str, start: int, edits: str) -> list[tuple[int, int | None, str | None]]:
    """(place among the edits, row or None for an insert, new role or None for
    kept) of all rows that stay."""
    state, row, out = start, 0, []
    for place, letter in enumerate(edits):
        if letter == DELETE:
            row += 1
            continue
        if letter == KEEP:
            state = _KEPT[initials[row]][1]
            out.append((place, row, None))
        else:
            state = _NEXT[state]
            out.append((place, None if letter == INSERT else row, ROLE[state]))
        if letter != INSERT:
            row += 1
    return out


# --- the same on tables -----------------------------------------------------

_BLANKS = r"[\x20\x09-\x0D]"


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


def _ordered(rows: DataFrame, slice_rows: int) -> DataFrame:
    """conv, slice, pos (row of the slice, from 0), turn, role, text, first (no
    earlier row has this role and text), copies (equal rows that follow).

    Ordinary conversations take one shuffle.  The rows of long ones are combined
    where they are equal, then range-partitioned on the whole order."""
    sizes = rows.groupBy("conv", "no_conv").agg(F.count("*").alias("n"))
    long_ones = materialise(sizes.filter(F.col("n") > slice_rows), "long")
    n_long = long_ones.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    who = ["conv", "no_conv"]
    ordinary = rows.join(long_ones.select(*who), who, "left_anti") if n_long else rows
    by_turn = Window.partitionBy(*who).orderBy(*_order())
    out = ordinary.select(
        *who, F.lit(0).alias("slice"), (F.row_number().over(by_turn) - 1).alias("pos"), "turn", "role", "text",
        (F.row_number().over(Window.partitionBy(*who, "role", "text").orderBy(F.col("turn").asc_nulls_first())) == 1)
        .alias("first"), F.lit(0).cast("long").alias("copies"))
    if not n_long:
        return out
    heavy = (rows.join(long_ones.select(*who), who, "left_semi")
             .groupBy(*who, "turn", "role", "text").agg((F.count("*") - 1).alias("copies")))
    lead = heavy.groupBy(*who, "role", "text").agg(F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn")).alias("lead"))
    heavy = (heavy.join(lead, [*who, "role", "text"])
             .withColumn("first", F.struct(F.col("turn").isNotNull().alias("some"), "turn").eqNullSafe(F.col("lead")))
             .drop("lead"))
    n = max(2, math.ceil(2 * n_long / slice_rows))
    cut = materialise(heavy.repartitionByRange(n, *who, *_order()).withColumn("slice", F.spark_partition_id()), "cut")
    in_slice = Window.partitionBy(*who, "slice").orderBy(*_order())
    return out.unionByName(cut.withColumn("pos", F.row_number().over(in_slice) - 1).select(*out.columns))


_MATRIX = "array<struct<start: int, end: int, cost: long, edits: string>>"


def _solve(initials: pd.Series, faults: pd.Series, whole: pd.Series) -> pd.Series:
    """Best edits of a slice from every state (of a whole conversation: from nothing)."""
    return pd.Series([[{"start": s, "end": e, "cost": cost, "edits": text}
                       for s in ([NOTHING] if alone else range(4)) for e, (cost, text) in slice_edits(i, f, s).items()]
                      for i, f, alone in zip(initials, faults, whole, strict=True)], dtype=object)


_JOINED = "cost long, audit string, slices array<struct<slice: int, start: int, edits: string>>"


def _join(slices: pd.Series) -> pd.DataFrame:
    """Best edits of a conversation from those of its slices (structs of slice, ways)."""
    out = []
    for of_conv in slices:
        parts = sorted(of_conv, key=lambda p: p["slice"])
        tables: list[dict] = []
        for p in parts:
            table: dict[int, dict] = {}
            for w in p["ways"]:
                table.setdefault(w["start"], {})[w["end"]] = (w["cost"], w["edits"])
            tables.append(table)
        cost, path = join_slices(tables)
        chosen = [t[s][e][1] for t, (s, e) in zip(tables, path, strict=True)]
        out.append((cost, "".join(chosen), [{"slice": p["slice"], "start": s, "edits": text}
                                            for p, (s, _), text in zip(parts, path, chosen, strict=True)]))
    return pd.DataFrame(out, columns=["cost", "audit", "slices"])


_PLACES = "array<struct<place: int, row: int, role: string>>"


def _applied(initials: pd.Series, start: pd.Series, edits: pd.Series) -> pd.Series:
    return pd.Series([[{"place": p, "row": r, "role": role} for p, r, role in edited_rows(i, int(s), e)]
                      for i, s, e in zip(initials, start, edits, strict=True)], dtype=object)


def repair(conversations: DataFrame, key: str = "conv_id", slice_rows: int = SLICE_ROWS) -> tuple[DataFrame, DataFrame]:
    """(audits, rows) of the cheapest repair of every conversation.

    ``conversations``: key, turn, role, text; null roles and texts are one space.
    Rows are taken by turn (nulls first), those of one turn by role and text.  A
    row's first fault counts: blank (no character but blanks), duplicate (an
    earlier row has this role and text), truncated (the last other character is
    none of ``.!?``).

    audits, one row per key: gaps, blank, duplicate, truncated, illegal (adjacent
    initials other than su, ua, au), cost, audit (edit initials).  rows: key,
    slice, place (their order), role, text of the repaired conversations.  Rows
    with a null key are one conversation.  Other columns are ignored; an empty
    table gives two empty results."""
    rows = conversations.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("conv"), F.col(key).isNull().alias("no_conv"),
        F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"))
    who = ["conv", "no_conv"]
    key_type = conversations.schema[key].dataType
    own = F.when(~F.col("no_conv"), F.col("conv").cast(key_type)).alias(key)
    bare = F.regexp_replace("text", f"{_BLANKS}+$", "")
    fault = (F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK).when(~F.col("first"), DUPLICATE)
             .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(SOUND))
    initial = F.substring("role", 1, 1)
    rows = materialise(_ordered(rows, slice_rows).select(
        *who, "slice", "pos", "turn", "role", "text", "copies", fault.alias("fault"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("?")).alias("initial")), "ordered")
    in_order = F.array_sort(F.collect_list(F.struct(
        "pos", F.concat("initial", F.expr("repeat(initial, cast(copies as int))")).alias("initials"),
        # equal rows that follow the first are duplicates, or as blank as it is
        F.concat("fault", F.expr(f"repeat(if(fault = '{BLANK}', '{BLANK}', '{DUPLICATE}'), cast(copies as int))")).alias("faults"))))
    slices = rows.groupBy(*who, "slice").agg(in_order.alias("list"), F.min("turn").alias("low"), F.max("turn").alias("high"))
    slices = slices.select(*who, "slice", "low", "high", F.array_join("list.initials", "").alias("initials"),
                           F.array_join("list.faults", "").alias("faults"))
    n_slices = rows.select(*who, "slice").distinct().groupBy(*who).agg(F.count("*").alias("n_slices"))
    solved = materialise(slices.join(n_slices, who).withColumn("ways", F.pandas_udf(_solve, _MATRIX)("initials", "faults", F.col("n_slices") == 1)), "solved")
    of_slice = F.struct("slice", "ways")

    def faults_of(kind: str) -> Column:
        return F.sum(F.length("faults") - F.length(F.replace("faults", F.lit(kind), F.lit("")))).alias(kind)

    legal = F.length(F.regexp_replace(F.regexp_replace("initials", "(?<=[sa])u|(?<=u)a", "."), r"[^.]", ""))
    joined = materialise(
        solved.groupBy(*who).agg(_sorted_slices(of_slice), faults_of(BLANK), faults_of(DUPLICATE), faults_of(TRUNCATED),
                                 F.sum(F.length("initials") - 1 - legal).alias("inside"),
                                 F.array_sort(F.collect_list(F.struct("slice", F.substring("initials", 1, 1).alias("head"),
                                                                      F.substring("initials", -1, 1).alias("end")))).alias("edges"),
                                 F.min("low").alias("low"), F.max("high").alias("high"))
        .withColumn("best", F.pandas_udf(_join, _JOINED)("slices")).drop("slices"), "joined")
    turns = (rows.filter("turn is not null").select(*who, "turn").distinct().groupBy(*who).agg(F.count("*").alias("turns")))
    seams = F.aggregate(F.sequence(F.lit(1), F.size("edges")), F.lit(0).cast("long"), lambda n, i: n + F.when(
        (i < F.size("edges")) & ~F.concat(F.element_at("edges", i)["end"],
                                         F.get("edges", i)["head"]).isin("su", "ua", "au"), 1).otherwise(0))
    audits = joined.join(turns, who, "left").select(
        own, F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("long").alias("gaps"),
        F.col(BLANK).cast("long").alias("blank"), F.col(DUPLICATE).cast("long").alias("duplicate"),
        F.col(TRUNCATED).cast("long").alias("truncated"), (F.col("inside") + seams).cast("long").alias("illegal"),
        "best.cost", "best.audit")
    chosen = joined.select(*who, F.inline("best.slices")).join(solved.select(*who, "slice", "initials"), [*who, "slice"])
    stay = (chosen.withColumn("edit", F.explode(F.pandas_udf(_applied, _PLACES)("initials", "start", "edits")))
            .select(*who, "slice", "edit.place", "edit.row", F.col("edit.role").alias("new")))
    # rows of the string that are copies of one row of the table are all deleted but the first
    at = Window.partitionBy(*who, "slice").orderBy("pos")
    placed = rows.withColumn("row", (F.sum(F.col("copies") + 1).over(at) - F.col("copies") - 1).cast("int"))
    own_rows = stay.filter("row is not null").join(placed.select(*who, "slice", "row", "role", "text"), [*who, "slice", "row"])
    put_in = stay.filter("row is null").select(*who, "slice", "place", F.col("new").alias("role"), F.lit("").alias("text"))
    repaired = own_rows.select(*who, "slice", "place", F.coalesce("new", "role").alias("role"), "text").unionAll(put_in)
    return audits, repaired.select(own, "slice", "place", "role", "text")


def _sorted_slices(of_slice: Column) -> Column:
    return F.array_sort(F.collect_list(of_slice), lambda a, b: a["slice"] - b["slice"]).alias("slices")


def repaired_digests(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """key, repaired_sha256: lowercase hex digest of the repaired rows of ``repair``
    as ``role:text`` joined by newlines.  A digest reads its rows one after the
    other, so a conversation's rows stream through one task, sorted outside the
    memory; nothing of them is held."""
    named = rows.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("conv"), F.col(key).isNull().alias("no_conv"),
                        "slice", "place", "role", "text")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, digest = None, None
        for frame in frames:
            done = []
            for conv, no_conv, role, text in zip(frame["conv"], frame["no_conv"], frame["role"], frame["text"], strict=True):
                if (conv, no_conv) != now:
                    if now is not None:
                        done.append((*now, digest.hexdigest()))
                    now, digest = (conv, no_conv), hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            yield pd.DataFrame(done, columns=["conv", "no_conv", "repaired_sha256"])
        if now is not None:
            yield pd.DataFrame([(*now, digest.hexdigest())], columns=["conv", "no_conv", "repaired_sha256"])

    key_type = rows.schema[key].dataType
    return (named.repartition("conv", "no_conv").sortWithinPartitions("conv", "no_conv", "slice", "place")
            .mapInPandas(run, "conv string, no_conv boolean, repaired_sha256 string")
            .select(F.when(~F.col("no_conv"), F.col("conv").cast(key_type)).alias(key), "repaired_sha256"))


def damaged(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """Rows with planted faults, by crc32(``key:turn``) mod 20 (nulls are one
    space): 0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats
    it, 4 sets the role user.  key, turn, role, text."""
    blank = F.lit(" ")
    name = F.concat_ws(":", F.coalesce(F.col(key).cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank))
    rows = conversations.select(key, "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
                                (F.crc32(name.cast("binary")) % 20).alias("draw")).filter("draw <> 0")
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("draw") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("draw") == 3, 2).otherwise(1)
    return (rows.select(key, "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("n"))
            .drop("n"))
