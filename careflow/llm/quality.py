"""Compression quality classifier (operator 10).

Two zstandard dictionaries are built, one from texts labelled good and one from
texts labelled bad.  A text is compressed with each, in blocks of equal size so
that the dictionary counts as much at the end of a long text as at its start.
The difference of the compressed sizes, per byte of text, and the text's length
go through a logistic function, which is fitted on labelled texts that the
dictionaries have not seen.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careflow.llm.common import text_udf

#: Labelled documents of each class to fit on (the bound of the sample), and the
#: code points of each that are used, from a pseudo-random place in longer ones.
#: Scoring always reads whole texts.
SAMPLE_PER_CLASS = 3000
SAMPLE_CHARS = 4000
DICTIONARY_BYTES = 112_640
BLOCK_BYTES = 1024
LEVEL = 3


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries (bytes, whether trained) of bad [0] and good [1] text, and
    the logistic function's mean, scale and weights; ``prior`` is the share of
    label 1.  Without both classes there are no dictionaries: the score of any
    text is then the prior."""

    dictionaries: tuple[bytes, bytes] | None
    trained: tuple[bool, bool]
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    prior: float


def held_out(key: str = "doc_id", of: int = 5, remainder: int = 0) -> Column:
    """Whether crc32(key as text) mod ``of`` is ``remainder``; false for a null key."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % of == remainder, F.lit(False))


def _sizes(model: QualityModel):
    """A function: compressed bytes with each dictionary, of a text's bytes."""
    compressors = []
    for data, trained in zip(model.dictionaries, model.trained, strict=True):
        kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
        dictionary = zstandard.ZstdCompressionDict(data, dict_type=kind)
        dictionary.precompute_compress(level=LEVEL)
        compressors.append(zstandard.ZstdCompressor(dict_data=dictionary, level=LEVEL, write_content_size=False,
                                                    write_checksum=False, write_dict_id=False))
    bad, good = compressors

    def sizes(raw: bytes) -> tuple[int, int]:
        a = b = 0
        for i in range(0, len(raw), BLOCK_BYTES):
            block = raw[i:i + BLOCK_BYTES]
            a += len(bad.compress(block))
            b += len(good.compress(block))
        return a, b

    return sizes


def _features(raws: list[bytes], sizes) -> np.ndarray:
    n = np.array([len(r) for r in raws], float)
    ab = np.array([sizes(r) for r in raws], float).reshape(-1, 2)
    d = (ab[:, 0] - ab[:, 1]) / np.maximum(n, 1)
    log_n = np.log1p(n)
    return np.column_stack([np.ones(len(n)), d, d * log_n, log_n])


def _dictionary(raws: list[bytes]) -> tuple[bytes, bool]:
    """A trained dictionary, or the texts themselves where they are too few to train on."""
    parts = [r[i:i + BLOCK_BYTES] for r in raws for i in range(0, len(r), BLOCK_BYTES)]
    total = sum(map(len, parts))
    if len(parts) >= 100 and total >= 10 * 1024:
        try:
            return zstandard.train_dictionary(min(DICTIONARY_BYTES, total // 4), parts).as_bytes(), True
        except zstandard.ZstdError:
            pass
    return b"".join(parts)[-DICTIONARY_BYTES:] or b" ", False


def fit(texts: list[str], labels: list[int], prior: float | None = None) -> QualityModel:
    """Fit on labelled texts.  Of each class, every second text goes into the
    dictionary and the others calibrate; ``prior`` is the share of label 1 that
    the calibration stands for (by default that of the labels given)."""
    by_class: list[list[bytes]] = [[], []]
    for text, label in zip(texts, labels, strict=True):
        by_class[label].append(text.encode("utf-8"))
    if prior is None:
        prior = len(by_class[1]) / len(labels) if labels else 0.5
    if min(len(c) for c in by_class) < 2:
        return QualityModel(None, (False, False), (), (), (), prior)
    built = [_dictionary(c[0::2]) for c in by_class]
    model = QualityModel((built[0][0], built[1][0]), (built[0][1], built[1][1]), (), (), (), prior)
    rest = [c[1::2] for c in by_class]
    x = _features(rest[0] + rest[1], _sizes(model))
    y = np.repeat([0.0, 1.0], [len(rest[0]), len(rest[1])])
    weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    mean, scale = x.mean(axis=0), x.std(axis=0)
    mean[0], scale[0] = 0, 1
    scale[scale == 0] = 1
    z, w = (x - mean) / scale, np.zeros(x.shape[1])
    for _ in range(50):  # Newton steps of the weighted, slightly ridged logistic likelihood
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z.T * (weight * p * (1 - p))) @ z + 1e-2 * np.eye(len(w))
        w = w + np.linalg.solve(hessian, z.T @ (weight * (y - p)) - 1e-2 * w)
    return QualityModel(model.dictionaries, model.trained, tuple(mean), tuple(scale), tuple(w), prior)


def fit_on_tables(docs: DataFrame, labels: DataFrame, train: Column, key: str = "doc_id",
                  per_class: int = SAMPLE_PER_CLASS, chars: int = SAMPLE_CHARS) -> QualityModel:
    """Fit on at most ``per_class`` labelled documents of each class, those with
    the smallest hash of the key among the labels for which ``train`` holds.
    Labels other than 0 and 1, null keys and texts are left out; of repeated
    labels of a key the smallest counts, of its texts the least."""
    known = (labels.filter(F.col("quality").isin(0, 1) & F.col(key).isNotNull() & train)
             .groupBy(key).agg(F.min("quality").cast("int").alias("quality")))
    n = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}  # two rows
    total = sum(n.values())
    prior = n.get(1, 0) / total if total else 0.5
    draw = F.xxhash64(key, F.lit("quality sample"))
    chosen = None
    for q in (0, 1):
        part = known.filter(F.col("quality") == q).orderBy(draw, key).limit(per_class)  # the sample's bound
        chosen = part if chosen is None else chosen.unionAll(part)
    begin = F.pmod(draw, F.greatest(F.length("text") - chars, F.lit(0)) + 1).cast("int") + 1
    rows = (docs.select(key, "text").join(F.broadcast(chosen), key).filter(F.col("text").isNotNull())
            .select("quality", F.substring(F.col("text"), begin, F.lit(chars)).alias("text"), draw.alias("draw"),
                    F.col(key).alias("key"))
            .groupBy("key", "draw", "quality").agg(F.min("text").alias("text")).collect())  # 2 * per_class rows of `chars` code points at most
    rows.sort(key=lambda r: (r["draw"], r["key"]))
    return fit([r["text"] for r in rows], [r["quality"] for r in rows], prior)


def score_udf(model: QualityModel, threshold: float):
    """Column function: score and predicted of whole texts."""

    def prepare():
        sizes = _sizes(model) if model.dictionaries else None

        def work(texts: list[str]) -> pd.DataFrame:
            p = np.full(len(texts), model.prior)
            full = [i for i, t in enumerate(texts) if t]
            if sizes and full:
                x = _features([texts[i].encode("utf-8") for i in full], sizes)
                z = (x - np.array(model.mean)) / np.array(model.scale)
                p[full] = 1 / (1 + np.exp(-np.clip(z @ np.array(model.weights), -30, 30)))
            return pd.DataFrame({"score": p, "predicted": (p >= threshold).astype(np.int32)})

        return work

    return text_udf("score double, predicted int", prepare)


def score(docs: DataFrame, model: QualityModel, threshold: float = 0.3, key: str = "doc_id") -> DataFrame:
    """Score every whole text: key, score (0 to 1), predicted (1 if score >= threshold).

    Null and empty texts have nothing to compress and get the prior.  One row
    per input row, repeated or null keys included; other columns are ignored."""
    return docs.select(F.col(key), score_udf(model, threshold)("text").alias("r")).select(key, "r.*")
