import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from careflow.llm import bpe, token_counts

ALPHABET = list("ab 's't  \n\t'relld  vé中1 2٣!?’   \x1c\x85🙂é<|endoftext|>'' \r\n")


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(3)
    out = ["".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, 60))) for _ in range(3000)]
    return out + ["", " ", "\n\n a", "a" * 3000, "ab" * 2000, " " * 500 + "x", "é" * 700, "!?" * 600,
                  "".join(draw.choice("etaoinshr") for _ in range(5000))]


def split(encoder, texts):
    ids, first = encoder.encode(texts)
    return [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]


def test_pretokens_are_the_matches_of_the_pattern(texts):
    pattern = regex.compile(P.PATTERN)
    data, offsets, first, _ = bpe.pretokens(texts)
    raw = data.tobytes()
    words = [raw[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    for text, a, b in zip(texts, first[:-1], first[1:], strict=True):
        assert words[a:b] == [m.encode() for m in pattern.findall(text)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_ids_equal_the_rank_file_library(texts, name):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(name), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = bpe.rank_file_encoder(P.path(name))
    got = split(encoder, texts)
    assert got == [library.encode_ordinary(t) for t in texts]
    assert split(encoder, texts) == got  # from the memory of encoded matches
    for ids, text in zip(got, texts, strict=True):
        assert encoder.decode(np.array(ids, np.int64)) == text.encode()


def test_ids_equal_the_merge_file_library(texts):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    encoder = bpe.merge_file_encoder(P.path("byte_bpe_50k.json"))
    assert split(encoder, texts) == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_memory_of_matches_is_bounded(texts, monkeypatch):
    encoder = bpe.merge_file_encoder.__wrapped__(P.path("byte_bpe_50k.json"))
    want = split(encoder, texts)
    monkeypatch.setattr(bpe, "_MEMO_TOKENS", 10)
    assert split(encoder, texts) == want
    assert split(encoder, texts) == want


def test_digests_of_odd_rows(odd_docs, no_docs):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    rows = bpe.encode_digest(odd_docs, path).collect()
    want = odd_docs.collect()
    assert len(rows) == len(want)
    key = lambda r: (r[0] is None, r[0] or 0, r["decoded_sha256"] if "decoded_sha256" in r else "")
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert sorted((r["doc_id"] or -1, r["decoded_sha256"]) for r in rows) == sorted((r["doc_id"] or -1, sha(r["text"])) for r in want)
    empty = next(r for r in rows if r["doc_id"] == 2)
    assert empty["n_tokens"] == 0 and empty["ids_sha256"] == sha("")
    assert bpe.encode_digest(no_docs, path).count() == 0
    assert key(rows[0]) is not None


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts_against_offsets_one_by_one(spark, rule):
    path = P.path("byte_bpe_50k.json")
    texts = ["one two\n\n\nthree  four\n", "\n", "é\n\nü x\n \n", "no line end", "a\n  b\n\n\n\n c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["doc_id"], r["section"]): r for r in token_counts.token_counts(docs, path, rule).collect()}
    encoder = bpe.merge_file_encoder(path)
    for n, text in enumerate(texts):
        raw = text.encode()
        starts = [0] + [i + 1 for i, b in enumerate(raw) if b == 10 and i + 1 < len(raw)]
        ids, at = split(encoder, [text])[0], 0
        want = [0] * len(starts)
        for i in ids:
            end = at + len(encoder.bytes_of[i])
            lines = [max(k for k, s in enumerate(starts) if s <= b) for b in range(at, end)]
            most = min(sorted(set(lines)), key=lambda k: -lines.count(k))
            want[{"start": lines[0], "end": lines[-1], "largest": most}[rule]] += 1
            at = end
        assert [got[n, k]["n_tokens"] for k in range(len(starts))] == want
        assert sum(want) == len(ids)
        pieces = text.splitlines(keepends=True)
        assert [got[n, k]["end_char"] - got[n, k]["start_char"] for k in range(len(starts))] == [len(p) for p in pieces]


def test_token_counts_of_odd_rows(odd_docs, no_docs):
    path = P.path("byte_bpe_50k.json")
    rows = token_counts.token_counts(odd_docs, path).collect()
    assert sum(r["doc_id"] is None for r in rows) == 3
    assert [(r["section"], r["n_tokens"]) for r in rows if r["doc_id"] == 3] == [(0, 0)]
    assert len([r for r in rows if r["doc_id"] == 7]) == 3
    assert token_counts.token_counts(no_docs, path).count() == 0
    with pytest.raises(ValueError):
        token_counts.token_counts(no_docs, path, "none")
