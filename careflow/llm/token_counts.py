"""Token counts by section from one encoding of the whole document (operator 8).

A document is encoded once, as a whole.  The spans of its tokens are joined to
the spans of its sections by their sorted starts.  A token that crosses a
boundary goes to one section, by an explicit rule:

``start``    the section of its first byte;
``end``      the section of its last byte;
``largest``  the section that holds most of its bytes, the earlier one in a tie.

So the sections' counts always add up to the document's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from careflow.llm.bpe import merge_file_encoder
from careflow.llm.common import chunks, keyed_texts, with_key

RULES = ("start", "end", "largest")


def owners(starts: np.ndarray, token_from: np.ndarray, token_to: np.ndarray,
           rule: str) -> tuple[np.ndarray, np.ndarray]:
    """The section of each token, and whether the token crosses a boundary.
    ``starts``: sorted section starts; tokens cover [from, to), never empty."""
    first = np.searchsorted(starts, token_from, side="right") - 1
    last = np.searchsorted(starts, token_to - 1, side="right") - 1
    crosses = first != last
    if rule == "start":
        return first, crosses
    if rule == "end":
        return last, crosses
    owner = first.copy()
    for i in np.flatnonzero(crosses):
        edges = np.concatenate([[token_from[i]], starts[first[i] + 1:last[i] + 1], [token_to[i]]])
        owner[i] = first[i] + int(np.diff(edges).argmax())
    return owner, crosses


def token_counts(docs: DataFrame, path: str, rule: str = "start", key: str = "doc_id") -> DataFrame:
    """Tokens of each line of each whole text.

    A section is a line with its line feed.  One row per section: key, section
    (from 0), start_char, end_char (code points), n_tokens, n_crossing (of these,
    tokens that also cover another section).  A null or empty text is one empty
    section without tokens, so every row of ``docs`` appears.  Repeated rows
    each give their own sections; other columns are ignored."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = merge_file_encoder(path)
        size = encoder.token_lengths()
        for frame, texts in chunks(frames):
            raw = [t.encode("utf-8") for t in texts]
            data = np.frombuffer(b"".join(raw), np.uint8)
            text_from = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
            ids, _ = encoder.encode(texts)
            token_to = np.cumsum(size[ids])
            token_from = token_to - size[ids]
            lines = np.flatnonzero(data == 10) + 1
            # a section begins with each text and after each line feed inside a text;
            # an empty text shares its start with the next one and gets no token
            inner = np.setdiff1d(lines, text_from)
            starts = np.unique(np.concatenate([text_from[:-1][np.diff(text_from) > 0], inner]))
            owner, crosses = owners(starts, token_from, token_to, rule)
            n = np.bincount(owner, minlength=len(starts))
            over = np.bincount(owner[crosses], minlength=len(starts))
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            begin = chars[starts]
            end = chars[np.append(starts[1:], len(data))] if len(starts) else begin
            text_of = np.searchsorted(text_from, starts, side="right") - 1
            number = np.arange(len(starts)) - np.searchsorted(text_of, text_of)
            empty = np.flatnonzero(np.diff(text_from) == 0)
            none = np.zeros(len(empty), np.int64)
            at = chars[text_from[text_of]]
            which = np.concatenate([text_of, empty])
            yield pd.DataFrame({
                "key": frame["key"].to_numpy()[which],
                "section": np.concatenate([number, none]).astype(np.int32),
                "start_char": np.concatenate([begin - at, none]), "end_char": np.concatenate([end - at, none]),
                "n_tokens": np.concatenate([n, none]), "n_crossing": np.concatenate([over, none])})

    return with_key(keyed_texts(docs, key).mapInPandas(
        run, "key string, section int, start_char long, end_char long, n_tokens long, n_crossing long"), docs, key)
