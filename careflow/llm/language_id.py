"""Language identification by interpolated Kneser-Ney character models (operator 1).

A text is folded to lower-case letters with single spaces between runs of them.
Every language has a character model of order 4 with interpolated Kneser-Ney
smoothing.  The n-grams of each order that any language has seen lie in one
sorted array of 64-bit hashes; beside it stand, for every language, the fully
interpolated log probability of the n-gram and the weight that its context
gives to shorter n-grams.  A character costs one binary search if its 4-gram is
known, and falls back to shorter ones otherwise.

The language with the lowest cross-entropy per character wins.  Its confidence
is the posterior under a temperature fitted on texts that the models have not
seen.  Rejection is calibrated on the same texts: a text is rejected if its best
cross-entropy is above the ceiling of that language at its length, or if the
posterior is low.  A ceiling is a high quantile of the cross-entropies of unseen
texts of the language, taken length by length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from careflow.llm.bpe import _LETTER, _classes
from careflow.llm.common import text_udf

ORDER = 4
DISCOUNT = 0.75
#: Training documents of each language (the bound of the sample) and the code
#: points of each that are used, from a pseudo-random place in longer ones.
#: Prediction always reads whole texts.
SAMPLE_PER_LANGUAGE = 800
SAMPLE_CHARS = 3000
#: Languages that are learned at most.
MAX_LANGUAGES = 200
#: Lengths of the stretches of unseen texts that calibrate, and how many of each a text gives.
STRETCHES, STRETCHES_PER_TEXT = (8, 15, 30, 60, 120, 400, 3000), 4
#: Quantile of unseen cross-entropies that is the ceiling, the same of the normal
#: distribution, and the stretches of one length that it takes.
CEILING_QUANTILE, CEILING_Z, LEAST_STRETCHES = 0.999, 3.09, 20
#: Least posterior of an accepted text.
LEAST_SCORE = 0.5
UNDETERMINED = "und"

_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Order:
    """n-grams of one order: sorted hashes; per language the log probability and
    the log weight left to shorter n-grams after the n-gram as a context."""

    hashes: np.ndarray
    log_p: np.ndarray
    log_back: np.ndarray


@dataclass(frozen=True)
class LanguageModels:
    languages: tuple[str, ...]
    orders: tuple[Order, ...]  # of 1 .. ORDER characters
    log_unseen: np.ndarray  # per language: a character never seen
    temperature: float
    ceiling: tuple[float, float]  # highest accepted cross-entropy, all languages: a + b / sqrt(characters)
    ceilings: np.ndarray  # the same of each language

    def limit(self, language: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Highest accepted cross-entropy of texts of ``n`` characters in a language."""
        a, b = self.ceilings[language].T
        return a + b / np.sqrt(np.maximum(n, 1))


def fold(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the folded texts in a row, the first of each (and the end),
    and the number of letters of each.  A folded text begins and ends with a space."""
    lower = [t.lower() for t in texts]
    points = np.frombuffer("".join([t + " " for t in lower]).encode("utf-32-le"), np.uint32)
    sizes = np.array([len(t) + 1 for t in lower], np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    letter = _classes()[points] == _LETTER
    keep = letter.copy()
    keep[1:] |= ~letter[1:] & letter[:-1]  # the first non-letter after a letter
    letters = np.add.reduceat(letter.astype(np.int64), bounds[:-1]) if len(texts) else np.zeros(0, np.int64)
    folded = np.where(letter, points, np.uint32(32))[keep]
    before = np.concatenate([[0], np.cumsum(keep)])[bounds]
    out = np.insert(folded, before[:-1], 32)  # each text's characters are preceded by one space
    return out, before + np.arange(len(before)), letters


def _hashes(points: np.ndarray, first: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``order`` characters that end at each place, and whether they
    lie within one text."""
    mixed = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(31)
    code = mixed.copy()
    for k in range(1, order):
        code[k:] = code[k:] + mixed[:-k] * _POWERS[k]
    place = np.arange(len(points)) - np.repeat(first[:-1], np.diff(first))
    code ^= code >> np.uint64(33)
    return code * _STEP, place >= order - 1


_POWERS = [np.uint64(pow(0xBF58476D1CE4E5B9, k, 2**64)) for k in range(8)]


def _find(sorted_hashes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each hash, or -1."""
    if not len(sorted_hashes):
        return np.full(len(wanted), -1, np.int64)
    at = np.searchsorted(sorted_hashes, wanted)
    at[at == len(sorted_hashes)] = 0
    return np.where(sorted_hashes[at] == wanted, at, -1)


def fit_orders(texts_by_language: list[list[str]]) -> tuple[tuple[Order, ...], np.ndarray]:
    """Kneser-Ney models of all languages over shared sorted arrays of hashes."""
    n_lang = len(texts_by_language)
    grams: list[list[dict]] = [[None] * n_lang for _ in range(ORDER)]  # per order and language
    alphabet: set[int] = set()
    for lang, texts in enumerate(texts_by_language):
        points, first, _ = fold(texts)
        alphabet |= set(np.unique(points).tolist())
        for n in range(1, ORDER + 1):
            code, whole = _hashes(points, first, n)
            at = np.flatnonzero(whole)
            shorter = _hashes(points, first, n - 1)[0] if n > 1 else None
            unique, index, count = np.unique(code[at], return_index=True, return_counts=True)
            entry = {"hash": unique, "count": count.astype(float)}
            if n > 1:
                entry["context"] = shorter[at[index] - 1]  # all characters but the last
                entry["suffix"] = shorter[at[index]]  # all but the first
            grams[n - 1][lang] = entry
    for lang in range(n_lang):  # below the highest order: the number of different characters before
        for n in range(1, ORDER):
            longer = grams[n][lang]
            u, c = np.unique(longer["suffix"], return_counts=True)
            entry = grams[n - 1][lang]
            kept = np.zeros(len(entry["hash"]))
            at = _find(entry["hash"], u)
            kept[at[at >= 0]] = c[at >= 0]
            entry["count"] = np.maximum(kept, 1e-9)
    size = max(1, len(alphabet)) + 1
    hashes = [np.unique(np.concatenate([g["hash"] for g in grams[n]] or [np.zeros(0, np.uint64)])) for n in range(ORDER)]
    log_p = [np.zeros((len(h), n_lang)) for h in hashes]
    back = [np.ones((len(h), n_lang)) for h in hashes]
    log_unseen = np.zeros(n_lang)
    for lang in range(n_lang):
        entry = grams[0][lang]
        total = max(entry["count"].sum(), 1e-9)
        spare = min(1.0, DISCOUNT * len(entry["hash"]) / max(total, 1.0)) or 1.0
        log_unseen[lang] = np.log(spare / size)
        p = np.full(len(hashes[0]), spare / size)
        p[_find(hashes[0], entry["hash"])] += np.maximum(entry["count"] - DISCOUNT, 0) / max(total, 1.0)
        log_p[0][:, lang] = p
        for n in range(1, ORDER):
            g = grams[n][lang]
            # each context: total, and different characters after it
            contexts, inverse = np.unique(g["context"], return_inverse=True)
            total = np.bincount(inverse, g["count"], len(contexts))
            kinds = np.bincount(inverse, minlength=len(contexts))
            weight = np.minimum(1.0, DISCOUNT * kinds / total)
            at = _find(hashes[n - 1], contexts)
            back[n - 1][at[at >= 0], lang] = weight[at >= 0]
            alpha = np.zeros(len(hashes[n]))
            alpha[_find(hashes[n], g["hash"])] = np.maximum(g["count"] - DISCOUNT, 0) / total[inverse]
            log_p[n][:, lang] = alpha
    # interpolate: every known n-gram gets its full probability in every language
    context_of = [None] * ORDER
    suffix_of = [None] * ORDER
    for n in range(1, ORDER):
        context_of[n] = np.zeros(len(hashes[n]), np.uint64)
        suffix_of[n] = np.zeros(len(hashes[n]), np.uint64)
        for g in grams[n]:
            at = _find(hashes[n], g["hash"])
            context_of[n][at], suffix_of[n][at] = g["context"], g["suffix"]
        context, suffix = _find(hashes[n - 1], context_of[n]), _find(hashes[n - 1], suffix_of[n])
        log_p[n] += back[n - 1][context] * log_p[n - 1][suffix]
    orders = tuple(Order(h, np.log(p).astype(np.float32), np.log(b).astype(np.float32))
                   for h, p, b in zip(hashes, log_p, back, strict=True))
    return orders, log_unseen.astype(np.float32)


def _log_probabilities(points: np.ndarray, first: np.ndarray, orders: tuple[Order, ...],
                       log_unseen: np.ndarray) -> np.ndarray:
    """log P of each character in each language (the first of a text counts 0)."""
    out = np.zeros((len(points), len(log_unseen)), np.float32)
    todo = np.flatnonzero(np.arange(len(points)) != np.repeat(first[:-1], np.diff(first)))
    known = {}

    def found(n: int, at: np.ndarray) -> np.ndarray:
        if n not in known:
            known[n] = _hashes(points, first, n)
        code, whole = known[n]
        place = _find(orders[n - 1].hashes, code[at])
        return np.where(whole[at], place, -1)

    for n in range(ORDER, 0, -1):
        place = found(n, todo)
        hit = place >= 0
        out[todo[hit]] += orders[n - 1].log_p[place[hit]]
        todo = todo[~hit]
        if not len(todo):
            return out
        if n > 1:  # what the context of the unknown n-gram leaves to shorter ones
            context = found(n - 1, todo - 1)
            seen = context >= 0
            out[todo[seen]] += orders[n - 2].log_back[context[seen]]
    out[todo] += log_unseen
    return out


def cross_entropies(texts: list[str], orders: tuple[Order, ...],
                    log_unseen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: cross-entropy per character in every language, characters, letters."""
    points, first, letters = fold(texts)
    log_p = _log_probabilities(points, first, orders, log_unseen)
    n = np.diff(first) - 1
    sums = np.add.reduceat(log_p.astype(np.float64), first[:-1]) if len(texts) else np.zeros((0, len(log_unseen)))
    return -sums / np.maximum(n, 1)[:, None], n, letters


def _posterior(entropy: np.ndarray, n: np.ndarray, temperature: float) -> np.ndarray:
    z = -entropy * (n * temperature)[:, None]
    z -= z.max(axis=1, keepdims=True)
    e = np.exp(z)
    return e / e.sum(axis=1, keepdims=True)


def fit(texts: list[str], langs: list[str]) -> LanguageModels | None:
    """Fit models and calibrate.  Of every language, three of four texts train;
    the fourth, cut into stretches of many lengths, calibrates.  None without texts."""
    languages = tuple(sorted(set(langs)))
    if not languages:
        return None
    train: list[list[str]] = [[] for _ in languages]
    rest: list[tuple[str, int]] = []
    for text, lang in zip(texts, langs, strict=True):
        k = languages.index(lang)
        n = len(train[k]) + sum(1 for _, x in rest if x == k)
        if n % 4 == 3:
            rest.append((text, k))
        else:
            train[k].append(text)
    orders, log_unseen = fit_orders(train)
    parts, places = [], []
    for size in STRETCHES:  # one length at a time bounds the memory
        pieces, truth = [], []
        for text, k in rest:
            pieces += [text[a:a + size] for a in range(0, min(len(text), STRETCHES_PER_TEXT * size), size)]
            truth += [k] * (len(pieces) - len(truth))
        for at in range(0, len(pieces), max(1, 400_000 // size)):
            cut = slice(at, at + max(1, 400_000 // size))
            entropy, n, letters = cross_entropies(pieces[cut], orders, log_unseen)
            ok = letters > 2
            parts.append((entropy[ok], n[ok]))
            places.append(np.array(truth[cut], int)[ok])
    truth = np.concatenate(places) if places else np.zeros(0, int)
    if not len(truth):
        return LanguageModels(languages, orders, log_unseen, 1.0, (np.inf, 0.0), np.array([(np.inf, 0.0)] * len(languages)))
    entropy, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    steps = np.geomspace(0.02, 2, 40)
    loss = [-np.log(_posterior(entropy, n, t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in steps]
    # what a text of the language reaches where it is recognised
    right = entropy.argmin(axis=1) == truth
    own = entropy[np.arange(len(truth)), truth]
    ceiling = _ceiling(own[right], n[right]) or (np.inf, 0.0)
    ceilings = [_ceiling(own[of], n[of]) or ceiling for of in (right & (truth == k) for k in range(len(languages)))]
    return LanguageModels(languages, orders, log_unseen, float(steps[int(np.argmin(loss))]), ceiling, np.array(ceilings))


def _ceiling(own: np.ndarray, n: np.ndarray) -> tuple[float, float] | None:
    """a, b of the lowest a + b / sqrt(n) that is at no length below the quantile of the
    cross-entropies there; None if no length has LEAST_STRETCHES.

    Of fewer than 1 / (1 - CEILING_QUANTILE) stretches the quantile is but the
    largest; it is then at least that of a log-normal distribution with their
    mean and deviation."""
    length = np.searchsorted([12, 24, 48, 96, 192], n)
    high, typical = [], []
    for k in range(6):
        here = length == k
        if here.sum() >= LEAST_STRETCHES:
            logs = np.log(np.maximum(own[here], 1e-9))
            high.append(max(float(np.quantile(own[here], CEILING_QUANTILE)),
                            float(np.exp(logs.mean() + CEILING_Z * logs.std(ddof=1)))))
            typical.append(float(np.median(n[here])))
    if not high:
        return None
    a = high[-1]
    return a, max(0.0, *((h - a) * m ** 0.5 for h, m in zip(high, typical, strict=True)))


def fit_on_table(docs: DataFrame, train: Column, key: str = "doc_id",
                 per_language: int = SAMPLE_PER_LANGUAGE, chars: int = SAMPLE_CHARS,
                 max_languages: int = MAX_LANGUAGES) -> LanguageModels | None:
    """Fit on at most ``per_language`` documents of each language, those with the
    smallest hash of the key among the rows for which ``train`` holds and text,
    lang and key are not null; of rows with one language and key, on the one with
    the least text.  Of more than ``max_languages`` languages those with the most
    documents are learned (then by name), so a dirty column bounds the models."""
    known = docs.filter(train & F.col("lang").isNotNull() & F.col(key).isNotNull())
    n = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n"))
         .orderBy(F.col("n").desc(), "lang").limit(max_languages).collect()}  # one row a language
    if not n:
        return None
    # a hash threshold draws about a third more rows than the bound, then the bound cuts
    draw = F.pmod(F.xxhash64(key, F.lit("language sample")), F.lit(1_000_000_000))
    share = F.lit(0)
    for lang, count in n.items():
        most = min(1.0, (1.3 * per_language + 50) / count)
        share = F.when(F.col("lang") == lang, F.lit(int(most * 1_000_000_000))).otherwise(share)
    begin = F.pmod(draw, F.greatest(F.length("text") - chars, F.lit(0)) + 1).cast("int") + 1
    rows = known.filter((draw < share) & F.col("text").isNotNull()).select(
        "lang", F.substring(F.col("text"), begin, F.lit(chars)).alias("text"), draw.alias("draw"),
        F.col(key).alias("key")).groupBy("lang", "draw", "key").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: (r["draw"], r["key"], r["text"]))
    used = dict.fromkeys(n, 0)
    texts, langs = [], []
    for r in rows:
        if used[r["lang"]] < per_language:
            used[r["lang"]] += 1
            texts.append(r["text"])
            langs.append(r["lang"])
    return fit(texts, langs)


def language_udf(spark: SparkSession, models: LanguageModels | None):
    """Column function: lang_pred, score, cross_entropy and rejected of whole texts."""
    shared = spark.sparkContext.broadcast(models)  # a few MB, bounded by the sample

    def prepare():
        m = shared.value

        def work(texts: list[str]) -> pd.DataFrame:
            size = len(texts)
            pred, score = np.full(size, UNDETERMINED, object), np.zeros(size)
            low, rejected = np.full(size, np.nan), np.ones(size, bool)
            if m is not None and size:
                entropy, n, letters = cross_entropies(texts, m.orders, m.log_unseen)
                best = entropy.argmin(axis=1)
                least = entropy[np.arange(size), best]
                posterior = _posterior(entropy, n, m.temperature)[np.arange(size), best]
                real = letters > 0
                pred[real] = np.array(m.languages, object)[best[real]]
                score[real], low[real] = posterior[real], least[real]
                rejected = ~real | (posterior < LEAST_SCORE) | (least > m.limit(best, n))
            return pd.DataFrame({"lang_pred": pred, "score": score, "cross_entropy": low, "rejected": rejected})

        return work

    return text_udf("lang_pred string, score double, cross_entropy double, rejected boolean", prepare)


def identify(docs: DataFrame, models: LanguageModels | None, key: str = "doc_id") -> DataFrame:
    """Predict the language of every whole text.

    One row per input row: key, lang_pred (``und`` if the text is null or has no
    letter, or there are no models), score (posterior; 0 for ``und``),
    cross_entropy (nats per character; null for ``und``), rejected (``und``, a
    posterior below LEAST_SCORE, or a cross-entropy above the calibrated
    ceiling).  Only the text decides; keys may repeat or be null."""
    udf = language_udf(docs.sparkSession, models)
    return docs.select(F.col(key), udf("text").alias("r")).select(key, "r.*")
