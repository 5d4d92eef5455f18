"""Language identification as a mixture of languages per document.

Training counts hashed character n-grams (one to four characters of a word with
its edges) by language. A document's words are the observations of a mixture:
expectation-maximisation estimates in which proportions the languages produced
them. Which languages belong to the set is decided by the likelihood minus a
penalty for each language (as in BIC): starting from the best single language,
the language that gains most is added while the gain exceeds the penalty. The
predicted language is the one with the largest proportion, its score that
proportion.

The model is a matrix of languages by ``BUCKETS`` and is sent to every task;
training takes about ``TRAIN_PER_LANGUAGE`` documents of each language, chosen
by a hash of the id, which bounds the work of fitting (prediction covers every
document and its whole text).

Defined results: null texts and texts without a letter give ``und`` with score
0. A null lang is not learned from. Without any learned language every text
gives ``und``. Equal rows each give a row; ties between languages go to the
first by name. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from overflight.llm.common import portions, remainder

BUCKETS = 1 << 15
LONGEST = 4  # n-gram
TRAIN_PER_LANGUAGE = 5_000
PENALTY = 2.0  # times log(words) / 2 for each language added
STEPS = 25
SMOOTHING = 0.5
UNKNOWN = "und"
HELD_OUT = 1  # remainder modulo FOLDS
FOLDS = 3


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the text's n-grams and, for each word, where its n-grams start.

    The text is lower-cased and everything but letters separates words. A word
    has an edge mark on either side; n-grams lie inside one word.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4")
    if not len(points):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    letter = _letters(points)
    marked = np.zeros(len(points) + 2, dtype=np.uint64)
    marked[1:-1] = np.where(letter, points, 0)
    inside = marked > 0
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    word = np.cumsum(inside & ~np.concatenate(([False], inside[:-1])))
    buckets, owner = [], []
    # An n-gram may begin or end with an edge, but has none in the middle.
    run = np.zeros(len(marked), dtype=np.uint64)
    ok = np.ones(len(marked), dtype=bool)
    for n in range(1, LONGEST + 1):
        size = len(marked) - n + 1
        if size <= 0:
            break
        run = run[:size] * np.uint64(0x100000001B3) + marked[n - 1:] + np.uint64(1)
        if n == 1:
            use = inside
        elif n == 2:
            use = inside[:size] | inside[1:]
        else:
            use = ok = ok[:size] & inside[n - 2:n - 2 + size]
        place = np.flatnonzero(use)
        mixed = (run[place] ^ (run[place] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(n)
        buckets.append(((mixed ^ (mixed >> np.uint64(32))) % np.uint64(BUCKETS)).astype(np.int64))
        owner.append(np.where(inside[place], word[place], word[np.minimum(place + 1, len(word) - 1)]))
    owner, buckets = np.concatenate(owner), np.concatenate(buckets)
    order = np.argsort(owner, kind="stable")
    owner = owner[order]
    return buckets[order], np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))


_IS_LETTER = np.zeros(0x110000, dtype=bool)


def _letters(points: np.ndarray) -> np.ndarray:
    if not _IS_LETTER[ord("a")]:
        _IS_LETTER[[i for i in range(0x110000) if chr(i).isalpha()]] = True
    return _IS_LETTER[points]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in portions(batches, "text"):
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            if lang not in counts:
                counts[lang] = np.zeros(BUCKETS, dtype=np.int64)
            counts[lang] += np.bincount(grams(text)[0], minlength=BUCKETS)
    for lang, c in counts.items():
        used = np.flatnonzero(c)
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array([lang] * len(used), pa.string()), "bucket": pa.array(used, pa.int64()), "n": pa.array(c[used], pa.int64())})


def train(docs: DataFrame, per_language: int = TRAIN_PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Languages and their log probabilities by bucket, learned from rows with a language outside the held-out fold."""
    known = docs.select("doc_id", "lang", "text").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder("doc_id", FOLDS) != HELD_OUT))
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # a row for each language
    part = F.lit(0.0)
    for lang, size in sizes.items():
        part = F.when(F.col("lang") == lang, min(1.0, per_language / size)).otherwise(part)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    counted = known.where(draw < part).select("lang", "text").mapInArrow(_count, "lang STRING, bucket BIGINT, n BIGINT") \
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    langs = sorted(sizes)
    counts = np.zeros((len(langs), BUCKETS))
    for r in counted.collect():  # at most languages x BUCKETS rows
        counts[langs.index(r["lang"]), r["bucket"]] = r["n"]
    smooth = counts + SMOOTHING
    return langs, np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)


def _fit(likelihood: np.ndarray, share: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log likelihood, proportions and words' mixed likelihoods; ``likelihood`` is words x languages."""
    mixed = likelihood @ share
    for _ in range(STEPS):
        new = share * (likelihood.T @ (1 / mixed)) / len(likelihood)
        moved, share = np.abs(new - share).max(), new
        mixed = likelihood @ share
        if moved < 1e-4:
            break
    return float(np.log(mixed).sum()), share, mixed


def mixture(scores: np.ndarray, penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray]:
    """Chosen languages and their proportions from the words' log likelihoods (words x languages).

    A language is tried only where it can pay: every word at its best must gain
    more than the penalty, and a first small share of it must raise the
    likelihood (which is concave in the share).
    """
    top = scores.max(axis=1)
    # The floor keeps one odd word from deciding alone.
    likelihood = np.exp(np.maximum(scores - top[:, None], -20.0).astype(np.float64))
    cost = penalty * np.log(len(scores) + 1) / 2
    single = np.log(likelihood).sum(axis=0)
    chosen = [int(single.argmax())]
    best, share, mixed = float(single[chosen[0]]), np.ones(1), likelihood[:, chosen[0]]
    while len(chosen) < likelihood.shape[1]:
        ratio = likelihood / mixed[:, None]
        able = (np.log(np.maximum(ratio, 1.0)).sum(axis=0) > cost) & (ratio.sum(axis=0) > len(scores))
        tried = [
            (*_fit(likelihood[:, chosen + [i]], np.append(share * 0.8, 0.2)), i)
            for i in np.flatnonzero(able) if i not in chosen]
        if not tried:
            break
        value, shares, words, i = max(tried, key=lambda t: t[0])
        if value - best <= cost:
            break
        chosen, best, share, mixed = chosen + [int(i)], value, shares, words
    return np.array(chosen), share


def predict(text: str | None, langs: list[str], model: np.ndarray) -> tuple[str, float, str]:
    """Language, its proportion, and the whole set with proportions as text."""
    # A character lies in up to LONGEST n-grams, so their sum counts it as often.
    buckets, starts = grams(text or "")
    if not len(starts) or not langs:
        return UNKNOWN, 0.0, ""
    chosen, share = mixture(np.add.reduceat(model[:, buckets], starts, axis=1).T / LONGEST)
    order = sorted(range(len(chosen)), key=lambda i: (-share[i], langs[chosen[i]]))
    listed = ",".join(f"{langs[chosen[i]]}={share[i]:.3f}" for i in order)
    return langs[chosen[order[0]]], float(min(1.0, share[order[0]])), listed


def _predictor(langs: list[str], sent) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in portions(batches, "text"):
            found = [predict(text, langs, model) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id").cast(pa.int64()), "held_out": batch.column("held_out"),
                "lang_pred": pa.array([f[0] for f in found], pa.string()),
                "score": pa.array([f[1] for f in found], pa.float64()),
                "languages": pa.array([f[2] for f in found], pa.string())})

    return run


def identified(docs: DataFrame, per_language: int = TRAIN_PER_LANGUAGE) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, languages (the set with proportions)."""
    langs, model = train(docs, per_language)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select("doc_id", "text", (remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"))
    return rows.mapInArrow(
        _predictor(langs, sent), "doc_id BIGINT, held_out BOOLEAN, lang_pred STRING, score DOUBLE, languages STRING")
