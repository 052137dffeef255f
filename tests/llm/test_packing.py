import random
import zlib
from itertools import combinations

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from careflow.llm import packing


def sequences(segments, capacity):
    """All sequences of a plan, each a list of (offset, length)."""
    out = {}
    for size, a, b, each, first, offset in segments:
        for rank in range(a, b):
            k, j = divmod(rank - a, each)
            out.setdefault(first + k, []).append((offset + j * size, size))
    for s in out.values():
        at = 0
        for offset, size in sorted(s):
            assert offset == at
            at += size
        assert at <= capacity
    return out


@pytest.mark.parametrize("seed", range(30))
def test_plan_places_every_piece_once(seed):
    draw = random.Random(seed)
    capacity = draw.choice([10, 64, 1024])
    histogram = {draw.randint(1, capacity): draw.randint(1, 200) for _ in range(draw.randint(1, 60))}
    segments = packing.plan(histogram, capacity)
    made = sequences(segments, capacity)
    count = {}
    for s in made.values():
        for _, size in s:
            count[size] = count.get(size, 0) + 1
    assert count == histogram
    total = sum(s * n for s, n in histogram.items())
    large = sum(n for s, n in histogram.items() if 2 * s > capacity)
    bound = max(-(-total // capacity), large)
    assert bound <= len(made) <= bound * 1.25 + 2
    assert sorted(made) == list(range(len(made)))


def optimum(sizes, capacity):
    """Fewest sequences by exhaustive search."""
    sizes = sorted(sizes, reverse=True)
    best = len(sizes)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms)}.values():
            if rooms[k] >= sizes[i]:
                go(i + 1, [r - sizes[i] * (j == k) for j, r in enumerate(rooms)])
        go(i + 1, [*rooms, capacity - sizes[i]])

    go(0, [])
    return best


@pytest.mark.parametrize("seed", range(40))
def test_reduction_never_costs_a_sequence(seed):
    draw = random.Random(seed)
    capacity = draw.choice([10, 17, 24])
    sizes = [draw.randint(1, capacity) for _ in range(draw.randint(1, 9))]
    left = packing._Counts({s: sizes.count(s) for s in set(sizes)})
    fixed = packing.reduce_by_dominance(left, capacity)
    rest = [s for s, n in left.n.items() for _ in range(n)]
    assert sum(n for n, _ in fixed) + optimum(rest, capacity) == optimum(sizes, capacity)


def test_pieces_equal_the_library(spark):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = ["", "short text", "many words here " * 900, "y" * 9000, None, "end " * 1023, "end " * 1022]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packing.best_fit_packing(docs, P.path("byte_bpe_50k.json")).collect()
    for n, text in enumerate(texts):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        own = sorted((r for r in rows if r["doc_id"] == n), key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert sum(r["length"] for r in own) == len(ids) and own[0]["start"] == 0
        assert all(r["length"] == 1024 for r in own[1:]) and 1 <= own[0]["length"] <= 1024
        assert len(own) == -(-len(ids) // 1024)
        for r in own:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes())


def test_odd_rows_all_lie_in_sequences(odd_docs, no_docs):
    rows = packing.best_fit_packing(odd_docs, P.path("byte_bpe_50k.json")).collect()
    assert sum(r["doc_id"] is None for r in rows) == 3 and sum(r["doc_id"] == 7 for r in rows) == 3
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in by.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 1024
    assert all(a != b for a, b in combinations([(r["sequence_id"], r["offset"]) for r in rows], 2))
    assert packing.best_fit_packing(no_docs, P.path("byte_bpe_50k.json")).count() == 0
