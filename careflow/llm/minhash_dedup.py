"""Near-duplicate documents by HyperMinHash (operator 2).

Each distinct set of word shingles is sketched by REGISTERS registers: of the
smallest of the set's hashes under one function, a register keeps the number of
leading zeros and the next MANTISSA bits.  Bands of registers find candidates;
the collision-corrected estimate of the Jaccard similarity drops clear
non-links; the rest is confirmed on the full sets.

No list of pairs is made.  Texts with equal sets are one class, which has a
number of its own through the whole graph; keys come in only at the end, so a
key that repeats with another text joins nothing.  First every class is compared
with the smallest class of each of its buckets (at most BANDS comparisons a
class).  What links with it is one component with it, and needs no comparison
within.  Left are the classes of a bucket outside its main component: they are
compared with the rest of the bucket, block by block, each pair in the first
band that it shares, on registers alone; only classes that then still have a
partner bring their full sets.  So every component is exact, for a cost that is
linear in a group of copies.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careflow.llm.common import materialise, text_udf
from careflow.llm.components import connected_components

WORDS = 5
REGISTERS = 210
MANTISSA = 10
#: Two sets at the limit of similarity share no bucket with this probability at most.
MISSED = 1e-4
#: Classes of one block (on average, by hash): of registers, and of full sets.
BLOCK, SET_BLOCK = 512, 64

_LONG = 256


@lru_cache(maxsize=1)
def _constants():
    draw = np.random.default_rng(8191)
    odd = lambda n: draw.integers(1, 2**63, n, dtype=np.uint64) | np.uint64(1)
    return odd(256), odd(_LONG), odd(WORDS), odd(REGISTERS), odd(REGISTERS)


def band_shape(percent: int) -> tuple[int, int]:
    """(bands, registers of a band): the longest bands that miss a pair of this
    similarity with at most MISSED.  At 85: 30 bands of 7, a miss has probability
    1e-5, and two sets of similarity 0.3 share a bucket with 0.007; at 80: 35 of 6, 2e-5."""
    for rows in range(REGISTERS, 1, -1):
        bands = REGISTERS // rows
        if (1 - (percent / 100) ** rows) ** bands <= MISSED:
            return bands, rows
    return REGISTERS, 1


def _finish(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """Sorted 64-bit hashes of the distinct shingles of each text.

    A-Z are lower-cased; words are runs of bytes other than space and tab to
    carriage return.  A text of fewer words is one shingle; without words the
    set is empty."""
    values, powers, steps, _, _ = _constants()
    raws = [t.encode("utf-8").lower() + b" " for t in texts]  # bytes.lower() knows A-Z only
    data = np.frombuffer(b"".join(raws), np.uint8)
    text_from = np.concatenate([[0], np.cumsum([len(r) for r in raws])]).astype(np.int64)
    blank = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    inside = ~blank
    starts = np.flatnonzero(inside & np.concatenate([[True], blank[:-1]])) if len(data) else np.zeros(0, np.int64)
    if not len(starts):
        return [np.zeros(0, np.uint64) for _ in texts]
    ends = np.flatnonzero(inside & np.concatenate([blank[1:], [True]])) + 1
    place = _places(len(data), starts)
    terms = np.where(inside, values[data] * powers[np.minimum(place, _LONG - 1)], np.uint64(0))
    code = _finish(np.add.reduceat(terms, starts) + (ends - starts).astype(np.uint64))
    for i in np.flatnonzero(ends - starts >= _LONG):
        digest = hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8).digest()
        code[i] = np.uint64(int.from_bytes(digest, "little"))
    first = np.searchsorted(starts, text_from)
    rolled = np.zeros(max(0, len(code) - words + 1), np.uint64)
    for k in range(words):
        rolled += code[k:k + len(rolled)] * steps[k]
    rolled = _finish(rolled)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(rolled[a:b - words + 1]))
        elif b > a:
            out.append(_finish(np.array([(code[a:b] * steps[:b - a]).sum() + np.uint64(b - a)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _places(n: int, starts: np.ndarray) -> np.ndarray:
    """Distance of each byte from the last start (bytes before the first count from 0)."""
    bounds = np.concatenate([[0], starts, [n]])
    return np.arange(n) - np.repeat(bounds[:-1], np.diff(bounds))


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """HyperMinHash registers (uint16) of non-empty sets, one row each."""
    _, _, _, times, xor = _constants()
    out = np.empty((len(sets), REGISTERS), np.uint16)
    if not len(sets):
        return out
    flat = np.concatenate(sets)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]]).astype(np.int64)
    for j in range(REGISTERS):
        least = np.minimum.reduceat((flat ^ xor[j]) * times[j], at)
        fraction, exponent = np.frexp(least.astype(np.float64))
        zeros = np.clip(64 - exponent, 0, 63)
        mantissa = np.clip(((fraction * 2 - 1) * 2**MANTISSA).astype(np.int64), 0, 2**MANTISSA - 1)
        out[:, j] = (zeros << MANTISSA) | mantissa
    return out


#: Chance that the registers of two disjoint sets of like size agree: both in
#: one octave (1/3 for geometric octaves), then in one of 2**MANTISSA parts of it.
_COLLISION = 1 / 3 / 2**MANTISSA


def estimate(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Collision-corrected estimate of the Jaccard similarity of sketches."""
    agree = (many == one[None, :]).mean(axis=1)
    return np.maximum(0.0, (agree - _COLLISION) / (1 - _COLLISION))


def _sketcher():
    """Column function: n_shingles, class (digest of the set) and registers of
    whole texts; the last two are null for empty sets."""

    def prepare():
        def work(texts: list[str]) -> pd.DataFrame:
            sets = shingle_sets(texts)
            full = [i for i, s in enumerate(sets) if len(s)]
            registers: list[bytes | None] = [None] * len(sets)
            digest: list[bytes | None] = [None] * len(sets)
            for i, row in zip(full, sketches([sets[i] for i in full]), strict=True):
                registers[i] = row.astype("<u2").tobytes()
                digest[i] = hashlib.blake2b(sets[i].astype("<u8").tobytes(), digest_size=16).digest()
            return pd.DataFrame({"n_shingles": np.array([len(s) for s in sets], np.int64),
                                 "class": pd.Series(digest, dtype=object), "registers": pd.Series(registers, dtype=object)})

        return work

    return text_udf("n_shingles long, class binary, registers binary", prepare)


def _set_maker():
    """Column function: the full set of shingles of whole texts, as bytes."""

    def prepare():
        return lambda texts: pd.DataFrame({"shingles": pd.Series([s.astype("<u8").tobytes() for s in shingle_sets(texts)],
                                                                 dtype=object)})

    return text_udf("shingles binary", prepare)


def _registers(column: pd.Series) -> np.ndarray:
    return np.array(list(map(bytes, column)), f"V{2 * REGISTERS}").view("<u2").reshape(len(column), REGISTERS)


def _worth(percent: int) -> float:
    """Five standard deviations of the estimate below the limit."""
    sure = percent / 100
    return sure - 5 * (sure * (1 - sure) / REGISTERS) ** 0.5


def _linked(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * common >= percent * (len(one) + len(two) - common)


def _likely(percent: int):
    """Column function: whether the estimate of two sketches leaves a link possible."""
    worth = _worth(percent)

    def likely(one: pd.Series, two: pd.Series) -> pd.Series:
        agree = (_registers(one) == _registers(two)).mean(axis=1)
        return pd.Series((agree - _COLLISION) / (1 - _COLLISION) >= worth)

    return F.pandas_udf(likely, "boolean")


def _confirmed(percent: int):
    """Column function: whether two full sets link."""

    def confirmed(one: pd.Series, two: pd.Series) -> pd.Series:
        return pd.Series([_linked(np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8"), percent)
                          for a, b in zip(one, two, strict=True)], dtype=bool)

    return F.pandas_udf(confirmed, "boolean")


def _dealt(members: DataFrame, block: int, columns: list[str]) -> DataFrame:
    """Tasks (bucket, part, other_part) that bring each class outside its bucket's
    main component (role 1) together with every class of the bucket but its hub
    (role 0; every class was compared with the hub before).
    ``members``: bucket, node, rest (outside the main component) and ``columns``."""
    sizes = (members.groupBy("bucket").agg(F.count("*").alias("n"), F.sum(F.col("rest").cast("long")).alias("n_rest"))
             .filter("n > 1 and n_rest > 0")
             .select("bucket", F.ceil(F.col("n") / block).cast("int").alias("parts"),
                     F.ceil(F.col("n_rest") / block).cast("int").alias("rest_parts")))
    there = members.join(sizes, "bucket")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    other = F.pmod(F.xxhash64("node", F.lit(1)), F.col("rest_parts")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    by = ["bucket", "part", "other_part", "role", "node", "rest", *columns]
    home = there.select("*", part.alias("part"), every("rest_parts").alias("other_part"), F.lit(0).alias("role"))
    probes = there.filter("rest").select("*", every("parts").alias("part"), other.alias("other_part"), F.lit(1).alias("role"))
    return home.select(*by).unionAll(probes.select(*by))


def _partners(percent: int, bands: int, rows: int):
    """Of one task on registers: the classes that have a partner of another
    component which the estimate leaves possible, the pair's first shared band being this."""
    worth = _worth(percent)

    def find(task: pd.DataFrame) -> pd.DataFrame:
        home, probes = task[task["role"] == 0], task[task["role"] == 1]
        found: set[int] = set()
        if len(home) and len(probes):
            many = _registers(home["registers"])
            nodes, rest, comps = (home[c].to_numpy() for c in ("node", "rest", "comp"))
            band = int(task["band"].iloc[0])
            for node, comp, own in zip(probes["node"], probes["comp"], _registers(probes["registers"]), strict=True):
                may = np.flatnonzero((comps != comp) & ~(rest & (nodes >= node)))
                may = may[estimate(own, many[may]) >= worth]
                if len(may):
                    same = (many[may, :bands * rows] == own[:bands * rows]).reshape(len(may), bands, rows).all(axis=2)
                    may = may[same.argmax(axis=1) == band]
                if len(may):
                    found.add(node)
                    found.update(nodes[may].tolist())
        return pd.DataFrame({"bucket": np.full(len(found), task["bucket"].iloc[0], np.int64),
                             "node": np.array(sorted(found), np.int64)})

    return find


def _compare(percent: int):
    """Of one task on full sets: a spanning set of the confirmed links between components."""
    worth = _worth(percent)

    def compare(task: pd.DataFrame) -> pd.DataFrame:
        home, probes = task[task["role"] == 0], task[task["role"] == 1]
        links: list[tuple[int, int]] = []
        if len(home) and len(probes):
            sets = [np.frombuffer(s, "<u8") for s in home["shingles"]]
            many = _registers(home["registers"])
            nodes, rest, comps = (home[c].to_numpy() for c in ("node", "rest", "comp"))
            parent: dict[int, int] = {}

            def root(x: int) -> int:
                while parent.setdefault(x, x) != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            for node, comp, own, mine in zip(probes["node"], probes["comp"], _registers(probes["registers"]),
                                             probes["shingles"], strict=True):
                mine = np.frombuffer(mine, "<u8")
                for i in np.flatnonzero((estimate(own, many) >= worth) & ~(rest & (nodes >= node))):
                    a, b = root(int(comps[i])), root(int(comp))
                    if a != b and _linked(mine, sets[i], percent):
                        parent[a] = b
                        links.append((int(nodes[i]), int(node)))
        return pd.DataFrame(links, columns=["a", "b"], dtype=np.int64)

    return compare


def _with_sets(nodes: DataFrame, classes: DataFrame, repeated: DataFrame, docs: DataFrame) -> DataFrame:
    """node, shingles of the classes in ``nodes`` (distinct), from the text of one
    row of each.  ``classes``: node, id, copy of that row; ``docs``: id, copy, text;
    ``repeated``: classes whose id and copy several rows have, of which one is taken."""
    wanted = classes.join(nodes, "node", "left_semi").select("node", "id", "copy")
    single = docs.join(wanted.join(repeated, "node", "left_anti"), ["id", "copy"]).select("node", "text")
    several = docs.join(wanted.join(repeated, "node", "left_semi"), ["id", "copy"]).groupBy("node").agg(F.first("text").alias("text"))
    return single.unionAll(several).select("node", _set_maker()("text").getField("shingles").alias("shingles"))


def _components(classes: DataFrame, repeated: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """(node, component) of the classes that link with others."""
    bands, rows = band_shape(percent)
    size = 2 * rows
    banded = (classes.select("node", "registers", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band"))
              .select("node", "band", F.xxhash64("band", F.substring("registers", F.col("band") * size + 1, F.lit(size)))
                      .alias("bucket")))
    buckets = banded.groupBy("bucket").agg(F.min("node").alias("hub"), F.count("*").alias("n")).filter("n > 1")
    members = materialise(banded.join(buckets, "bucket"), "members")
    registers = classes.select("node", "registers")
    stars = members.filter("node <> hub").select("node", "hub").distinct()
    stars = materialise(
        stars.join(registers, "node")
        .join(registers.select(F.col("node").alias("hub"), F.col("registers").alias("hub_registers")), "hub")
        .filter(_likely(percent)("registers", "hub_registers")).select("node", "hub"), "stars")
    sets = materialise(_with_sets(stars.select("node").unionAll(stars.select(F.col("hub").alias("node"))).distinct(),
                                  classes, repeated, docs), "sets")
    hub_sets = sets.select(F.col("node").alias("hub"), F.col("shingles").alias("hub_shingles"))
    first = materialise(stars.join(sets, "node").join(hub_sets, "hub").filter(_confirmed(percent)("shingles", "hub_shingles"))
                        .select(F.col("node").alias("a"), F.col("hub").alias("b")), "links1")
    # what stands in a bucket outside the component of its hub
    comps = connected_components(first)
    comp_of = lambda c: comps.select(F.col("node").alias(c), F.col("component").alias(f"{c}_comp"))
    apart = (members.filter("n > 2 and node <> hub").join(comp_of("node"), "node", "left").join(comp_of("hub"), "hub", "left")
             .select("bucket", "band", "node", F.coalesce("node_comp", "node").alias("comp"),
                     F.coalesce("hub_comp", "hub").alias("main"))
             .select("bucket", "band", "node", "comp", (F.col("comp") != F.col("main")).alias("rest")))
    apart = materialise(apart, "apart")
    mixed = apart.groupBy("bucket").agg(F.max("rest").alias("some")).filter("some").select("bucket")
    apart = apart.join(mixed, "bucket", "left_semi").join(registers, "node")
    told = materialise(
        _dealt(apart, BLOCK, ["band", "comp", "registers"]).groupBy("bucket", "part", "other_part")
        .applyInPandas(_partners(percent, bands, rows), "bucket long, node long").distinct(), "partners")
    found = apart.join(told, ["bucket", "node"])
    more = _with_sets(told.select("node").distinct().join(sets.select("node"), "node", "left_anti"), classes, repeated, docs)
    full = materialise(sets.join(told.select("node").distinct(), "node", "left_semi").unionAll(more), "sets")
    second = (_dealt(found.join(full, "node"), SET_BLOCK, ["comp", "registers", "shingles"])
              .groupBy("bucket", "part", "other_part").applyInPandas(_compare(percent), "a long, b long"))
    return connected_components(first.unionAll(materialise(second, "links2")))


def near_duplicates(docs: DataFrame, percent: int = 85, key: str = "doc_id",
                    carry: tuple[str, ...] = ()) -> DataFrame:
    """Components of documents whose shingle sets have 100 * |A & B| >= percent * |A | B|.

    One row per input row: key, n_shingles (size of the set), component_id (the
    smallest key reachable by links, itself included), kept (key = component_id),
    first (its key and text are those of the one document that stands for its
    component: the smallest key, then the smallest hash of the text).
    The key must be integral.  Null and empty texts link with nothing.  A row
    with a null key links with nothing either: its component_id is null and it is
    kept.  Rows that repeat a key are rows like others: each has the component of
    its own text, and equal rows the same; ``kept`` then holds for every row
    whose key is its component's smallest.  Columns named in ``carry`` stay,
    others are ignored; an empty table gives an empty result."""
    own = F.struct(*carry) if carry else F.lit(0)
    rows = docs.select(F.col(key).cast("long").alias("id"), own.alias("own"), "text")
    keyed = rows.select("id", F.xxhash64("text").alias("copy"), "text")
    sketched = materialise(rows.select("id", "own", F.xxhash64("text").alias("copy"), _sketcher()("text").alias("s"))
                           .select("id", "own", "copy", "s.*"), "sketches")
    usable = sketched.filter(F.col("class").isNotNull() & F.col("id").isNotNull())
    classes = materialise(usable.groupBy("class").agg(F.min(F.struct("id", "copy")).alias("least"),
                                                      F.first("registers").alias("registers"))
                          .select("class", "least.*", "registers", F.monotonically_increasing_id().alias("node")), "classes")
    rows_of = usable.groupBy("id", "copy").agg(F.count("*").alias("n")).filter("n > 1").select("id", "copy")
    repeated = materialise(classes.join(rows_of, ["id", "copy"], "left_semi").select("node"), "repeated")
    components = _components(classes, repeated, keyed, percent)
    of_class = classes.select("class", "node", F.struct("id", "copy").alias("own_least")).join(components, "node", "left")
    least = of_class.filter("component is not null").groupBy("component").agg(F.min("own_least").alias("least"))
    of_class = (of_class.join(least, "component", "left").select("class", F.coalesce("least", "own_least").alias("least")))
    joined = sketched.drop("registers").join(of_class, "class", "left").withColumn("component", F.col("least.id"))
    key_type = docs.schema[key].dataType
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    carried = [F.col("own").getField(c).alias(c) for c in carry]
    return joined.select(F.col("id").cast(key_type).alias(key), *carried, "n_shingles",
                         component.cast(key_type).alias("component_id"),
                         F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
                         F.coalesce(F.struct("id", "copy") == F.col("least"), F.lit(True)).alias("first"))
