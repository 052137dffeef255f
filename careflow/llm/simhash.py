"""SimHash fingerprints and search within a Hamming radius (operator 7).

DataFrame functions only.  The terms of a text are its pairs of neighbouring
words.  Every occurrence of a term votes with the bits of its 64-bit hash, so a
term weighs as much as it is frequent; a bit of the fingerprint is set if more
than half of the votes are for it.  Two bits are counted in one long (32 bits
each), which makes 32 sums, combined on the map side.

Search: the 64 bits are cut into BLOCKS blocks.  If two fingerprints differ in
at most RADIUS bits, they agree in some BLOCKS - RADIUS blocks; for each choice
of these there is a table keyed by them (a permutation that puts them first).
A pair counts in the first table where it meets.
"""

from __future__ import annotations

import json
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from careflow.llm.common import materialise

BITS = 64
BLOCKS = 6
RADIUS = 3


def _signed(mask: int) -> int:
    return mask - 2**64 if mask >= 2**63 else mask


def block_masks(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """The bit mask of every table's key: all choices of blocks - radius blocks."""
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [_signed(sum(choice)) for choice in combinations(parts, blocks - radius)]


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def terms(words: str) -> Column:
    """Hashes of each word with the one after it (the last with nothing).
    ``words`` must be a column of its own: inside the function an expression
    would be computed anew for every word."""
    return F.transform(words, lambda w, i: F.xxhash64(w, F.coalesce(F.get(words, i + 1), F.lit(""))))


def _votes(term: Column) -> list[Column]:
    """Sums that count the votes for bits 2 g (low half) and 2 g + 1 (high half)."""
    out = []
    for g in range(BITS // 2):
        low = F.shiftrightunsigned(term, 2 * g).bitwiseAND(F.lit(1).cast("long"))
        high = F.shiftrightunsigned(term, 2 * g + 1).bitwiseAND(F.lit(1).cast("long"))
        out.append(F.sum(low + F.shiftleft(high, 32)).alias(f"votes{g}"))
    return out


def _fingerprint() -> Column:
    bits = []
    for g in range(BITS // 2):
        low = F.col(f"votes{g}").bitwiseAND(F.lit(2**32 - 1))
        high = F.shiftrightunsigned(f"votes{g}", 32)
        for k, count in ((2 * g, low), (2 * g + 1, high)):
            bits.append(F.when(2 * count > F.col("n_terms"), F.lit(_signed(1 << k)).cast("long")).otherwise(F.lit(0).cast("long")))
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def fingerprints(texts: DataFrame, keys: list[str], carry: list[str], text: str = "text") -> DataFrame:
    """keys, carry (numbers), fingerprint (long) of every row's text; ``keys``
    must tell the rows apart.  Equal texts have equal fingerprints."""
    split = texts.select(*keys, *carry, F.split(text, r"\s+").alias("words"))
    exploded = split.select(*keys, *carry, F.explode(terms("words")).alias("term"))
    counted = exploded.groupBy(*keys).agg(
        *_votes(F.col("term")), F.count("*").alias("n_terms"), *(F.max(c).alias(c) for c in carry))
    return counted.select(*keys, *carry, _fingerprint().alias("fingerprint"))


def within_radius(queries: DataFrame, index: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """For each distinct fingerprint of ``queries``, how many rows of ``index``
    (fingerprint) lie within the radius: (fingerprint, n_near).

    Rows with one fingerprint are counted before the search, so copies cost
    nothing; the search keeps every match."""
    masks = block_masks(blocks, radius)
    tables = F.array(*(F.lit(m).cast("long") for m in masks))
    keyed = lambda df: df.select("*", F.posexplode(tables).alias("table", "mask"))
    counted = index.groupBy("fingerprint").agg(F.count("*").alias("n"))
    i = (keyed(counted).select("fingerprint", "n", "table", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("part"))
         .alias("i"))
    q = (keyed(queries.select("fingerprint").distinct())
         .select("fingerprint", "table", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("part")).alias("q"))
    differ = F.col("q.fingerprint").bitwiseXOR(F.col("i.fingerprint"))
    first = F.coalesce(*(F.when(differ.bitwiseAND(F.lit(m).cast("long")) == 0, F.lit(t)) for t, m in enumerate(masks)))
    # a table's rows shrink so much in a shuffle that its size there says little: no broadcast
    met = q.hint("merge").join(i, (F.col("q.table") == F.col("i.table")) & (F.col("q.part") == F.col("i.part"))
                 & (F.bit_count(differ) <= radius) & (first == F.col("q.table")))
    return met.groupBy(F.col("q.fingerprint").alias("fingerprint")).agg(F.sum("i.n").alias("n_near"))


_PLACE = "none int, back long, tie long"


def first_of_parts(rows: DataFrame, parts: int) -> list[tuple[int, int, int]]:
    """The least place (none, back, tie) of each of at most ``parts`` ranges of
    ``rows``, in order.  Spark's sampled bounds on the whole place cut the ranges,
    so neither the spread of the keys nor a repeated one matters.  One row a part
    comes to the driver; any such list deals the rows, whatever a retry samples."""
    place = ["none", "back", "tie"]
    ranged = rows.select(*place).repartitionByRange(parts, *place)
    found = ranged.groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct(*place)).alias("least")).collect()
    return sorted(tuple(r["least"]) for r in found)


def part_of(place: Column, firsts: list[tuple[int, int, int]]) -> tuple[Column, Column]:
    """The number of the range that holds ``place``, and whether its first row lies
    there: a binary search in a constant array."""
    named = [dict(zip(("none", "back", "tie"), f, strict=True)) for f in firsts]
    table = F.from_json(F.lit(json.dumps(named)), f"array<struct<{_PLACE}>>")
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(len(firsts).bit_length()))))
    reached = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= len(firsts)) & (F.element_at(table, F.least(at + step, F.lit(len(firsts)))) <= place), at + step).otherwise(at))
    part = F.greatest(reached - 1, F.lit(0))
    return part, F.get(table, part) == place


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", radius: int = RADIUS, every: int = 20) -> DataFrame:
    """Fingerprints of whole texts and of their edited texts.

    The edited text: the last floor(n_chars / 2) code points are replaced by the
    first as many (or all) of the next document by descending key (after the
    last: the first; rows without a key come last; rows with one key are ordered
    by a hash of their text).  One row per input row, repeated ones too: key,
    n_chars, edited_sha256, fingerprint, edited_fingerprint (16 hexadecimal
    figures), near_edited, near_next (share of equal bits), n_near (other rows
    whose fingerprint lies within the radius, for keys divisible by ``every``,
    else null).  Null texts count as empty; other columns are ignored.

    The texts are shuffled once, dealt by ranges of key and text; each range also
    gets the first row of the following one.  Rows that are equal in key and text
    lie in one range."""
    spark = docs.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = docs.select(F.col(key).cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    # ascending (none, back, tie) is descending id, nulls last; no sum or difference of ids can overflow
    base = base.select("id", "text", F.col("id").isNull().cast("int").alias("none"),
                       F.coalesce(F.bitwise_not("id"), F.lit(0)).alias("back"), F.xxhash64("text").alias("tie"))
    firsts = first_of_parts(base, parts) or [(0, 0, 0)]
    place = F.struct("none", "back", "tie")
    part, leads = part_of(place, firsts)
    # the first row of each part also ends the part before; that of the first part ends the last
    before = F.when(F.col("at") > 0, F.col("at") - 1).otherwise(len(firsts) - 1)
    rows = base.select("*", part.alias("at"), leads.alias("leads")).select(
        "id", "text", "none", "back", "tie", F.inline(F.when(F.col("leads"), F.array(
            F.struct(F.col("at").alias("part"), F.lit(0).alias("guest")), F.struct(before.alias("part"), F.lit(1).alias("guest"))))
            .otherwise(F.array(F.struct(F.col("at").alias("part"), F.lit(0).alias("guest"))))))
    w = Window.partitionBy("part").orderBy("guest", "none", "back", "tie")
    lined = rows.select("part", "guest", "id", "text", F.lead("text").over(w).alias("next"),
                        F.row_number().over(w).alias("row"))
    n = F.length("text")
    k = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - k),
                      F.substring(F.coalesce("next", F.lit("")), F.lit(1), k))
    lined = lined.select("part", "row", "guest", "id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    digest = F.sha2(F.col("edited").cast("binary"), 256)
    quarters = [F.conv(F.substring(digest, 1 + 16 * q, 16), 16, -10).cast("long").alias(f"sha{q}") for q in range(4)]
    sha = [f"sha{q}" for q in range(4)]
    both = (lined.select("part", "row", "guest", "id", "n_chars", *quarters, F.posexplode(F.array("text", "edited")).alias("kind", "text")))
    prints = fingerprints(both, ["part", "row", "kind"], ["guest", "id", "n_chars", *sha])
    own, changed = (F.max(F.when(F.col("kind") == v, F.col("fingerprint"))).alias(name)
                    for v, name in ((0, "fingerprint"), (1, "edited_fingerprint")))
    paired = prints.groupBy("part", "row").agg(own, changed, *(F.max(c).alias(c) for c in ("guest", "id", "n_chars", *sha)))
    following = F.lead("fingerprint").over(Window.partitionBy("part").orderBy("row"))
    done = materialise(paired.withColumn("next", following).filter("guest = 0"), "fingerprints")
    queries = done.filter(F.col("id") % every == 0)
    near = within_radius(queries, done.select("fingerprint"), radius)
    likeness = lambda a, b: 1 - distance(F.col(a), F.col(b)) / BITS
    shown = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    # only the queries join their counts; all other rows would meet in one null key
    counted = queries.join(near, "fingerprint").unionByName(
        done.filter((F.col("id") % every != 0) | F.col("id").isNull()).withColumn("n_near", F.lit(None).cast("long")))
    return counted.select(
        F.col("id").cast(docs.schema[key].dataType).alias(key), "n_chars",
        F.concat(*(shown(c) for c in sha)).alias("edited_sha256"),
        shown("fingerprint").alias("fingerprint"), shown("edited_fingerprint").alias("edited_fingerprint"),
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next").alias("near_next"), (F.col("n_near") - 1).alias("n_near"))
