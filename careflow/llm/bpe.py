"""Byte-level BPE encoding and decoding with padded numpy matrices (operator 6).

Texts are cut into the matches of the usual byte-level pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``
by array operations on code-point classes.  Each distinct match is encoded once
per worker: matches are bucketed by length into padded matrices of token ids,
and in every round each row merges its leftmost pair of minimum rank.  Pairs are
looked up in an open-addressing hash table; rows without a mergeable pair leave
the matrix, and merged rows are compacted to the left.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from careflow.llm.common import chunks, keyed_texts, with_key

_NONE = np.int32(2**31 - 1)
#: Matches longer than this are encoded one by one (see ``_encode_long``).
_LONG = 256
#: Tokens kept of already encoded matches in one worker before it starts afresh.
_MEMO_TOKENS = 1_500_000

_LETTER, _NUMBER, _OTHER, _SPACE = 1, 2, 3, 4


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of each code point that the pattern tells apart."""
    table = np.full(0x110000, _OTHER, np.uint8)
    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    for kind, expression in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(expression, every):
            gap = lambda i: i + 0x800 * (i >= 0xD800)  # noqa: E731  surrogates are left out
            a, b = gap(m.start()), gap(m.end() - 1) + 1
            table[a:b] = kind
    table[0xD800:0xE000] = _OTHER
    return table


def pretokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cut texts into the pattern's matches.

    Returns the UTF-8 bytes of all texts in a row, the byte offset of each
    match (and the end), the first match of each text (and the end), and the
    first byte of each code point (and the end)."""
    joined = "".join(texts)
    data = np.frombuffer(joined.encode("utf-8"), np.uint8)
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    n = len(points)
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    if len(data) == n:
        byte_at = np.arange(n + 1, dtype=np.int64)
    else:
        byte_at = np.zeros(n + 1, np.int64)
        np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000), out=byte_at[1:])
    if not n:
        return data, np.zeros(1, np.int64), np.zeros(len(texts) + 1, np.int64), byte_at
    kind = _classes()[points]
    text_start = np.zeros(n + 1, bool)
    text_start[bounds] = True
    start = np.empty(n, bool)
    start[0] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    start |= text_start[:n]
    # the last space of a run before other text is a match's first character
    space = kind == _SPACE
    last = np.empty(n, bool)  # last of its run and followed by another character of the text
    last[:-1] = space[:-1] & ~space[1:]
    last[-1] = False
    last &= ~text_start[1:]
    start |= last
    blank = last & (points == 0x20)
    joins = np.flatnonzero(blank) + 1
    start[joins] = False
    # contractions: an apostrophe that begins a match, before s t re ve m ll d
    quote = np.flatnonzero((points == 0x27) & start)
    if len(quote):
        padded = np.concatenate([points, np.zeros(3, np.uint32)])
        inside = np.concatenate([text_start, np.ones(3, bool)])
        one, two = padded[quote + 1], padded[quote + 2]
        ok1 = ~inside[quote + 1]
        ok2 = ok1 & ~inside[quote + 2]
        single = ok1 & np.isin(one, [ord(c) for c in "stmd"])
        double = ok2 & (((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e")))
                        | ((one == ord("l")) & (two == ord("l"))))
        for hits, length in ((quote[single], 2), (quote[double], 3)):
            start[hits + 1] = False
            after = hits + length
            start[after[after < n]] = True
            # a space run or another class begins there anyway; a joined space stays joined
    starts = np.flatnonzero(start)
    first = np.searchsorted(starts, bounds)
    offsets = np.append(byte_at[starts], byte_at[n])
    return data, offsets, first, byte_at


class Encoder:
    """Encodes byte strings by a table of mergeable pairs.

    ``pairs``: (left id, right id) -> (rank, merged id); ``whole``: byte strings
    that become one id without merging (as the rank-file library does)."""

    def __init__(self, tokens: dict[bytes, int], left, right, rank, merged, whole: bool):
        self.bytes_of: dict[int, bytes] = {i: b for b, i in tokens.items()}
        self.byte_id = np.array([tokens[bytes([b])] for b in range(256)], np.int32)
        self.whole = tokens if whole else None
        keys = np.asarray(left, np.uint64) << np.uint64(32) | np.asarray(right, np.uint64)
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 3))))
        size = 1 << self.bits
        self.keys = np.full(size, np.uint64(2**64 - 1))
        self.rank = np.full(size, _NONE, np.int32)
        self.merged = np.full(size, -1, np.int32)
        rank, merged = np.asarray(rank, np.int32), np.asarray(merged, np.int32)
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):  # open addressing: one key settles in a free slot, the others move on
            at = slot[todo]
            free = self.keys[at] == np.uint64(2**64 - 1)
            self.keys[at[free]] = keys[todo[free]]
            settled = self.keys[at] == keys[todo]
            self.rank[at[settled]] = rank[todo[settled]]
            self.merged[at[settled]] = merged[todo[settled]]
            todo = todo[~settled]
            slot[todo] = (slot[todo] + 1) & (size - 1)
        self._forget()

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = (keys ^ (keys >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def _forget(self) -> None:
        self.memo: dict[int, int] = {}
        self.counts: list[np.ndarray] = []
        self.memo_tokens = 0
        self.store = np.zeros(1 << 16, np.int32)
        self.begin = np.zeros(1 << 14, np.int64)
        self.n_words = 0

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of pairs; ranks of unknown pairs are the largest int."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slot = self._slot(keys)
        seen = self.keys[slot]
        miss = np.flatnonzero((seen != keys) & (seen != np.uint64(2**64 - 1)))
        while len(miss):
            slot[miss] = (slot[miss] + 1) & ((1 << self.bits) - 1)
            seen = self.keys[slot[miss]]
            miss = miss[(seen != keys[miss]) & (seen != np.uint64(2**64 - 1))]
        return self.rank[slot], self.merged[slot]

    def _pair_ranks(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        left, right = ids[:, :-1], ids[:, 1:]
        rank = np.full(left.shape, _NONE, np.int32)
        merged = np.full(left.shape, -1, np.int32)
        real = right >= 0
        rank[real], merged[real] = self.look_up(left[real], right[real])
        return rank, merged

    def _merge_matrix(self, ids: np.ndarray) -> np.ndarray:
        """Rounds over a padded matrix (-1 fills rows up): the ids at the end."""
        out = ids.copy()
        rows = np.arange(len(ids))
        rank, merged = self._pair_ranks(ids)
        while len(rows) and ids.shape[1] > 1:
            at = rank.argmin(axis=1)  # the leftmost of the smallest
            best = rank[np.arange(len(rows)), at]
            live = best != _NONE
            if not live.all():
                done = rows[~live]
                out[done, : ids.shape[1]] = ids[~live]
                out[done, ids.shape[1]:] = -1
                ids, rank, merged, rows, at = ids[live], rank[live], merged[live], rows[live], at[live]
                if not len(rows):
                    break
            r = np.arange(len(rows))
            ids[r, at] = merged[r, at]
            width = ids.shape[1]
            columns = np.arange(width - 1)
            shift = columns[None, :] + (columns[None, :] > at[:, None])
            ids = np.take_along_axis(ids, shift, axis=1)
            pair_shift = columns[None, :-1] + (columns[None, :-1] >= at[:, None])
            rank = np.take_along_axis(rank, pair_shift, axis=1)
            merged = np.take_along_axis(merged, pair_shift, axis=1)
            for side in (at - 1, at):  # only the pairs beside the merge are new
                ok = np.flatnonzero((side >= 0) & (side < width - 2))
                if not len(ok):
                    continue
                left, right = ids[ok, side[ok]], ids[ok, side[ok] + 1]
                real = right >= 0
                rank[ok[~real], side[ok[~real]]] = _NONE
                got = self.look_up(left[real], right[real])
                rank[ok[real], side[ok[real]]], merged[ok[real], side[ok[real]]] = got
        if len(rows):
            out[rows, : ids.shape[1]] = ids
            out[rows, ids.shape[1]:] = -1
        return out

    def _encode_long(self, ids: np.ndarray) -> np.ndarray:
        """One long match.  A round merges every occurrence of the minimum-rank
        pair from the left; if that makes a pair of smaller rank, only the
        leftmost merge is kept, which is what single merges would have done."""
        ids = ids.copy()
        while len(ids) > 1:
            rank, merged = self.look_up(ids[:-1], ids[1:])
            low = rank.min()
            if low == _NONE:
                break
            hits = np.flatnonzero(rank == low)
            gap = np.diff(hits, prepend=-2) > 1
            run = np.flatnonzero(gap)
            place = np.arange(len(hits)) - np.repeat(run, np.diff(np.append(run, len(hits))))
            hits = hits[place % 2 == 0]  # of overlapping pairs every second, from the left
            new = self._apply(ids, hits, merged[hits[0]])
            if len(hits) > 1 and len(new) > 1 and self.look_up(new[:-1], new[1:])[0].min() < low:
                new = self._apply(ids, hits[:1], merged[hits[0]])
            ids = new
        return ids

    @staticmethod
    def _apply(ids: np.ndarray, hits: np.ndarray, merged: int) -> np.ndarray:
        new = ids.copy()
        new[hits] = merged
        keep = np.ones(len(ids), bool)
        keep[hits + 1] = False
        return new[keep]

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many byte strings in a row, and how many each has."""
        counts = np.ones(len(words), np.int64)
        lengths = np.array([len(w) for w in words], np.int64)
        rest = np.arange(len(words))
        done: list[tuple[np.ndarray, np.ndarray]] = []  # (words, their ids in a row)
        if self.whole is not None:
            direct = np.array([self.whole.get(w, -1) for w in words], np.int32)
            rest = np.flatnonzero(direct < 0)
            found = np.flatnonzero(direct >= 0)
            done.append((found, direct[found]))
        order = rest[np.argsort(lengths[rest], kind="stable")]
        ordered = lengths[order]
        at = 0
        while at < len(order):
            width = int(ordered[at])
            if width > _LONG:
                ids = self._encode_long(self.byte_id[np.frombuffer(words[order[at]], np.uint8)])
                counts[order[at]] = len(ids)
                done.append((order[at:at + 1], ids))
                at += 1
                continue
            cap = next(c for c in (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 24, 32, 64, 128, 256) if c >= width)
            to = min(int(np.searchsorted(ordered, cap, side="right")), at + max(1, 1_000_000 // cap))
            group = order[at:to]
            flat = np.frombuffer(b"".join([words[i] for i in group.tolist()]), np.uint8)
            matrix = np.full((len(group), cap), -1, np.int32)
            matrix[np.arange(cap)[None, :] < ordered[at:to][:, None]] = self.byte_id[flat]
            matrix = self._merge_matrix(matrix)
            real = matrix >= 0
            counts[group] = real.sum(axis=1)
            done.append((group, matrix[real]))
            at = to
        starts = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.int32)
        for group, ids in done:
            size = counts[group]
            ends = np.cumsum(size)
            out[np.arange(len(ids)) + np.repeat(starts[group] - (ends - size), size)] = ids
        return out, counts

    def _remember(self, codes: list[int], words: list[bytes]) -> None:
        ids, counts = self.encode_words(words)
        while self.memo_tokens + len(ids) > len(self.store):
            self.store = np.concatenate([self.store, np.zeros_like(self.store)])
        while self.n_words + len(words) + 1 > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
        self.store[self.memo_tokens:self.memo_tokens + len(ids)] = ids
        ends = self.memo_tokens + np.cumsum(counts)
        self.begin[self.n_words + 1:self.n_words + 1 + len(words)] = ends
        for k, code in enumerate(codes):
            self.memo[code] = self.n_words + k
        self.n_words += len(words)
        self.memo_tokens += len(ids)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts in a row, and the first token of each (and the end)."""
        ids, first, _ = self.encode_spans(texts)
        return ids, first

    def encode_spans(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``encode``; also the place in ``store`` of each match's ids is
        resolved, so the third value gives the first match of each text."""
        data, offsets, first, _ = pretokens(texts)
        n = len(offsets) - 1
        if not n:
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64), first
        codes = _word_codes(data, offsets)
        unique, index, inverse = np.unique(codes, return_index=True, return_inverse=True)
        if self.memo_tokens > _MEMO_TOKENS:
            self._forget()
        places = [self.memo.get(c, -1) for c in unique.tolist()]
        place = np.array(places, np.int64)
        new = np.flatnonzero(place < 0)
        if len(new):
            raw = data.tobytes()
            at = index[new]
            words = [raw[a:b] for a, b in zip(offsets[at].tolist(), offsets[at + 1].tolist(), strict=True)]
            place[new] = self.n_words + np.arange(len(new))
            self._remember(unique[new].tolist(), words)
        word = place[inverse]
        begin = self.begin[word]
        count = self.begin[word + 1] - begin
        ends = np.cumsum(count)
        total = int(ends[-1])
        source = np.arange(total) + np.repeat(begin - (ends - count), count)
        starts = np.append(ends - count, total)
        return self.store[source], starts[first], first

    def token_lengths(self) -> np.ndarray:
        """Bytes of each token id."""
        size = np.zeros(max(self.bytes_of) + 1, np.int64)
        for i, b in self.bytes_of.items():
            size[i] = len(b)
        return size

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that the ids stand for."""
        if not hasattr(self, "_flat"):
            size = self.token_lengths()
            self._size, self._at = size, np.concatenate([[0], np.cumsum(size)])
            self._flat = np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(len(size))), np.uint8)
        count = self._size[ids]
        ends = np.cumsum(count)
        if not len(ids):
            return b""
        source = np.arange(int(ends[-1])) + np.repeat(self._at[ids] - (ends - count), count)
        return self._flat[source].tobytes()


@lru_cache(maxsize=1)
def _hash_tables() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20240607)
    return draw.integers(1, 2**63, 256, dtype=np.uint64), draw.integers(1, 2**63, _LONG, dtype=np.uint64) | np.uint64(1)


def _word_codes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit code of each byte range; long ranges get theirs from blake2."""
    values, powers = _hash_tables()
    lengths = np.diff(offsets)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], lengths)
    np.minimum(place, _LONG - 1, out=place)
    codes = np.add.reduceat(values[data] * powers[place], offsets[:-1])
    codes ^= codes >> np.uint64(32)
    codes = codes * np.uint64(0xD6E8FEB86659FD93) + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    codes ^= codes >> np.uint64(29)
    for i in np.flatnonzero(lengths >= _LONG):
        digest = hashlib.blake2b(data[offsets[i]:offsets[i + 1]].tobytes(), digest_size=8).digest()
        codes[i] = np.uint64(int.from_bytes(digest, "little"))
    return codes


@lru_cache(maxsize=4)
def rank_file_encoder(path: str) -> Encoder:
    """An encoder of a rank file: a pair merges if its bytes are a token, and a
    match that is a token as a whole becomes that token."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    left, right, rank = [], [], []
    for token, r in ranks.items():
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None:
                left.append(a)
                right.append(b)
                rank.append(r)
    return Encoder(ranks, left, right, rank, rank, whole=True)


@lru_cache(maxsize=4)
def merge_file_encoder(path: str) -> Encoder:
    """An encoder of a JSON file with a vocabulary and an ordered list of merges.
    Strings of special tokens in a text are ordinary text."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shown = {chr(b): b for b in plain}
    shown |= {chr(0x100 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}
    raw = lambda s: bytes(shown[c] for c in s)
    vocabulary = model["vocab"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    tokens = {raw(s): i for s, i in vocabulary.items() if all(c in shown for c in s)}
    return Encoder(tokens, [vocabulary[a] for a, _ in merges], [vocabulary[b] for _, b in merges],
                   np.arange(len(merges)), [vocabulary[a + b] for a, b in merges], whole=False)


def encode_digest(docs: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """Encode every whole text and decode the ids again.

    One row per input row: key, n_tokens, ids_sha256 (of the decimal ids joined
    by commas), decoded_sha256 (of the decoded bytes).  Null texts count as
    empty; keys may repeat or be null; other columns are ignored."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = rank_file_encoder(path)
        decimal = [str(i) for i in range(max(encoder.bytes_of) + 1)]
        for frame, texts in chunks(frames):
            ids, first = encoder.encode(texts)
            listed = ids.tolist()
            tokens, digests, decoded = [], [], []
            for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                tokens.append(b - a)
                digests.append(hashlib.sha256(",".join([decimal[i] for i in listed[a:b]]).encode()).hexdigest())
                decoded.append(hashlib.sha256(encoder.decode(ids[a:b])).hexdigest())
            yield pd.DataFrame({"key": frame["key"].to_numpy(), "n_tokens": tokens, "ids_sha256": digests,
                                "decoded_sha256": decoded})

    return with_key(keyed_texts(docs, key).mapInPandas(
        run, "key string, n_tokens long, ids_sha256 string, decoded_sha256 string"), docs, key)
