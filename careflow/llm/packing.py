"""Best-fit packing after Martello-Toth dominance reduction (operator 4).

Documents are tokenised and cut into pieces of at most ``capacity`` tokens.  The
packing itself depends only on how many pieces there are of each length, at most
``capacity`` numbers, so the driver plans on that histogram, whatever the number
of documents:

1. reduction: for the longest remaining length, a set of partners that provably
   dominates every other is fixed for good, for as many sequences as there are
   such pieces;
2. the rest goes best fit, longest first, into what is then open.

The plan is a bounded list of segments ("the pieces of length s with ranks a to
b go, k a sequence, to sequences from q on, at offset o").  Every piece finds
its place by its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from careflow.llm.bpe import merge_file_encoder
from careflow.llm.common import chunks, keyed_texts, materialise, with_key

SEGMENTS = "length int, rank_from long, rank_to long, per_sequence long, first_sequence long, first_offset long"


def cut_pieces(docs: DataFrame, path: str, capacity: int, end_id: int, key: str = "doc_id") -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32.

    A document is its token ids and then ``end_id``.  Only documents of more
    than ``capacity`` ids are cut, into pieces of ``capacity``, of which the
    first may be shorter.  Null texts count as empty (one piece: the end id)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = merge_file_encoder(path)
        for frame, texts in chunks(frames):
            ids, first = encoder.encode(texts)
            ids = np.insert(ids, first[1:], end_id).astype("<u4")
            first = first + np.arange(len(first))
            keys = frame["key"].tolist()
            rows: list[tuple] = []
            for k, a, b in zip(keys, first[:-1].tolist(), first[1:].tolist(), strict=True):
                size = b - a
                cuts = [0, size] if size <= capacity else [0, *range(size % capacity or capacity, size + 1, capacity)]
                for piece, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    rows.append((k, piece, x, y - x, zlib.crc32(ids[a + x:a + y].tobytes())))
            yield pd.DataFrame(rows, columns=["key", "piece", "start", "length", "ids_crc32"])

    return with_key(keyed_texts(docs, key).mapInPandas(
        run, "key string, piece int, start long, length long, ids_crc32 long"), docs, key)


class _Counts:
    """Lengths still to place, in order, with their numbers."""

    def __init__(self, histogram: dict[int, int]):
        self.n = {s: c for s, c in histogram.items() if c > 0}
        self.sizes = sorted(self.n)

    def take(self, size: int, count: int) -> None:
        self.n[size] -= count
        if not self.n[size]:
            del self.n[size]
            self.sizes.remove(size)

    def largest(self, most: int, besides: int) -> int | None:
        """The largest length up to ``most``, one piece of ``besides`` being in use."""
        i = bisect_left(self.sizes, most + 1) - 1
        while i >= 0 and self.sizes[i] == besides and self.n[besides] < 2:
            i -= 1
        return self.sizes[i] if i >= 0 else None

    def smallest(self, how_many: int, besides: int) -> list[int]:
        out: list[int] = []
        for s in self.sizes:
            out += [s] * min(how_many - len(out), self.n[s] - (s == besides))
            if len(out) == how_many:
                break
        return out


def _best_pair(left: _Counts, room: int, besides: int) -> int:
    """The largest sum up to ``room`` of two further pieces; 0 if none."""
    best, spare = 0, {besides: 1}
    for a in left.sizes:
        if 2 * a > room:
            break
        if left.n[a] - spare.get(a, 0) < 1:
            continue
        i = bisect_left(left.sizes, room - a + 1) - 1
        while i >= 0 and left.sizes[i] >= a:
            b = left.sizes[i]
            if left.n[b] - spare.get(b, 0) >= 1 + (a == b):
                best = max(best, a + b)
                break
            i -= 1
    return best


def reduce_by_dominance(left: _Counts, capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Fix sets that dominate: (number of sequences, [(length, pieces a sequence)]).

    With the longest piece s and the room beside it: s alone, if nothing fits;
    s and the longest partner k, if k fills the room, if no two pieces fit, or
    if two but never three fit and no two sum to more than k (whatever else
    could lie beside s would fit where k lies)."""
    fixed = []
    for s in sorted(left.n, reverse=True):
        while s in left.n:
            room = capacity - s
            k = left.largest(room, s) if room else None
            if k is None:
                count = left.n[s]
                fixed.append((count, [(s, 1)]))
                left.take(s, count)
                break
            small = left.smallest(3, s)
            dominant = k == room or len(small) < 2 or small[0] + small[1] > room
            if not dominant and (len(small) < 3 or sum(small) > room):
                dominant = _best_pair(left, room, s) <= k
            if not dominant:
                break
            if k == s:
                count = left.n[s] // 2
                fixed.append((count, [(s, 2)]))
                left.take(s, 2 * count)
            else:
                count = min(left.n[s], left.n[k])
                fixed.append((count, [(s, 1), (k, 1)]))
                left.take(s, count)
                left.take(k, count)
    return fixed


def best_fit(left: _Counts, capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best fit, longest first, for all pieces of a length and all sequences with
    the same room at once (a piece goes where the least room is left over)."""
    open_by_room: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    rooms: list[int] = []

    def put(room: int, count: int, content: list[tuple[int, int]]) -> None:
        if count:
            if room not in open_by_room:
                open_by_room[room] = []
                insort(rooms, room)
            open_by_room[room].append((count, content))

    for s in sorted(left.n, reverse=True):
        m = left.n[s]
        while m:
            i = bisect_left(rooms, s)
            if i == len(rooms):
                each = capacity // s
                put(capacity - each * s, m // each, [(s, each)])
                if m % each:
                    put(capacity - m % each * s, 1, [(s, m % each)])
                m = 0
                break
            room = rooms[i]
            each = room // s
            count, content = open_by_room[room].pop()
            if not open_by_room[room]:
                del open_by_room[room]
                rooms.pop(i)
            full = min(count, m // each)
            put(room - each * s, full, [*content, (s, each)])
            m -= full * each
            count -= full
            if count and m:  # fewer than one sequence's pieces are left
                put(room - m * s, 1, [*content, (s, m)])
                count -= 1
                m = 0
            put(room, count, content)
    return [group for room in rooms for group in open_by_room[room]]


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Segments (see ``SEGMENTS``) that place every piece of the histogram."""
    left = _Counts(histogram)
    groups = reduce_by_dominance(left, capacity)
    groups += best_fit(left, capacity)
    used: dict[int, int] = {}
    segments, sequence = [], 0
    for count, content in groups:
        offset = 0
        for s, each in content:
            begin = used.get(s, 0)
            used[s] = begin + count * each
            segments.append((s, begin, used[s], each, sequence, offset))
            offset += s * each
        sequence += count
    return segments


def pack(pieces: DataFrame, capacity: int, key: str = "doc_id") -> DataFrame:
    """Add sequence_id and offset to pieces (key, piece, start, length, ids_crc32).

    Every piece lies in one sequence; offsets of a sequence are gapless from 0.
    Repeated rows and null keys are pieces like others.  An empty table gives an
    empty result.  The ranks within a length are counted in slices, so a length
    that many pieces share is spread over many tasks."""
    spark = pieces.sparkSession
    # at most `capacity` rows, whatever the number of documents
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    segments = spark.createDataFrame(plan(histogram, capacity), SEGMENTS)
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sliced = pieces.withColumn("slice", F.pmod(F.xxhash64(key, "piece", "start", "ids_crc32"), F.lit(slices)))
    before = (sliced.groupBy("length", "slice").agg(F.count("*").alias("n"))
              .select("length", "slice", (F.sum("n").over(Window.partitionBy("length").orderBy("slice"))
                                          - F.col("n")).alias("before")))
    ranked = sliced.withColumn("rank", F.row_number().over(
        Window.partitionBy("length", "slice").orderBy(key, "piece", "start", "ids_crc32")) - 1)
    ranked = (ranked.join(before, ["length", "slice"])
              .withColumn("rank", F.col("rank") + F.col("before")).drop("before", "slice"))
    p, s = ranked.alias("p"), F.broadcast(segments).alias("s")  # a few segments a length
    place = F.col("p.rank") - F.col("s.rank_from")
    placed = p.join(s, (F.col("p.length") == F.col("s.length")) & (F.col("p.rank") >= F.col("s.rank_from"))
                    & (F.col("p.rank") < F.col("s.rank_to")))
    return placed.select(
        F.col(f"p.{key}").alias(key), "p.piece", "p.start", "p.length", "p.ids_crc32",
        (F.col("s.first_sequence") + F.floor(place / F.col("s.per_sequence"))).cast("long").alias("sequence_id"),
        (F.col("s.first_offset") + F.pmod(place, F.col("s.per_sequence")) * F.col("p.length")).cast("long").alias("offset"))


def best_fit_packing(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2,
                     key: str = "doc_id") -> DataFrame:
    """Tokenise, cut and pack whole documents: one row per piece with its place."""
    return pack(materialise(cut_pieces(docs, path, capacity, end_id, key), "pieces"), capacity, key)
