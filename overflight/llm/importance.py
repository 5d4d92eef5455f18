"""Importance resampling towards a target distribution.

A text is seen as a bag of hashed features: its words and the runs of up to
``longest`` consecutive words. A table of 256 bytes lower-cases A-Z and blanks
every other ASCII character that is neither letter nor digit, directly in the
UTF-8 bytes; ``bytes.split`` then yields the words. The crc32 of a run is
extended word by word, each step seeded with the crc of the run before, so no
run is ever put together as a string. Counters reduce the buckets of a task
before anything is shuffled; what reaches the driver is one number per bucket.

The gain of a bucket is its log ratio between the target texts and the
documents, a document's weight the mean gain of its features. Gumbel noise
from the id makes the highest scores a draw without replacement in proportion
to the weights. Ranks come from a sorted, stored table: rows carry their place
in their part, and the parts' sizes give the places in front.

Defined results: null and empty texts and texts without words have no features
and weight 0. A null id counts as empty in the noise and comes last among equal
scores. Rows are drawn one by one, also repeated ones: equal rows have equal
scores and neighbouring ranks. Texts may have any length (they are cut in
pieces of ``PIECE`` bytes, runs go on across the cut). Without documents
nothing is returned, without target texts every gain follows from the formula.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from overflight.llm.common import ROWS_PER_FILE, broadcast_if_small, in_files, portions, stored

BUCKETS = 10_000
PIECE = 1 << 20
MANY_PARTS = 1_000_000
PLACE_BITS = 33  # of monotonically_increasing_id, below the part's number

# Letters lower-cased, digits and bytes of other characters as they are, the rest blank.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, by pieces of about ``PIECE`` bytes that end between words."""
    plain = text.translate(TABLE)
    start = 0
    while start < len(plain):
        end = plain.find(b" ", start + PIECE)
        end = len(plain) if end < 0 else end
        yield plain[start:end].split()
        start = end


def features(text: bytes, longest: int) -> Iterator[list[int]]:
    """crc32 of every run of 1 to ``longest`` words, list by list; the first list of a piece is that of its words."""
    before: list[bytes] = []
    for found in pieces(text):
        words = before + found
        crcs = list(map(crc32, words))
        yield crcs[len(before):]
        for size in range(2, longest + 1):
            # A run goes on with the word after it; runs that ended in the piece before are known.
            crcs = list(map(crc32, words[size - 1:], map(crc32, repeat(b" "), crcs)))
            yield crcs[max(0, len(before) - size + 1):]
        before = words[len(words) - min(len(words), longest - 1):]


def _buckets(crcs: list[int], buckets: int) -> np.ndarray:
    return np.array(crcs, dtype=np.int64) % buckets


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in portions(batches, "text"):
        yield batch, [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def bucket_counts(texts: DataFrame, longest: int = 2, buckets: int = BUCKETS) -> dict[int, int]:
    """How often each bucket occurs in all texts; at most ``buckets`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[int] = Counter()
        for _, found in _texts(batches):
            for text in found:
                for crcs in features(text, longest):
                    held.update(_buckets(crcs, buckets).tolist())
        yield pa.RecordBatch.from_pydict({
            "bucket": pa.array(held.keys(), pa.int32()), "n": pa.array(held.values(), pa.int64())})

    counted = texts.select("text").mapInArrow(run, "bucket INT, n BIGINT").groupBy("bucket").agg(F.sum("n").alias("n"))
    return {row.bucket: row.n for row in counted.collect()}


def gains(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """Log ratio of the smoothed shares by bucket, in thousandths, rounded down."""
    all_source, all_target = sum(source.values()), sum(target.values())
    ratio = ((float(target.get(b, 0) + 1) * float(all_source + buckets)) / (float(source.get(b, 0) + 1) * float(all_target + buckets))
             for b in range(buckets))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], dtype=np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise in thousandths from the id."""
    drawn = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((drawn + 0.5) / 4294967296)))


def _weigh(gain: np.ndarray, longest: int, seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _texts(batches):
            ids = batch.column("doc_id").cast(pa.int64())
            n_words, n_features, weights = [], [], []
            for text in texts:
                words = total = gained = 0
                for i, crcs in enumerate(features(text, longest)):
                    words += len(crcs) if i % longest == 0 else 0
                    total += len(crcs)
                    gained += int(gain[_buckets(crcs, len(gain))].sum())
                n_words.append(words)
                n_features.append(total)
                weights.append(gained // total if total else 0)
            scores = [w + noise(d, seed) for w, d in zip(weights, ids.to_pylist())]
            longs = lambda values: pa.array(values, pa.int64())
            yield pa.RecordBatch.from_pydict({
                "doc_id": ids, "n_words": longs(n_words), "n_features": longs(n_features), "weight": longs(weights), "score": longs(scores)})

    return run


def ranked(rows: DataFrame, n: int, *order) -> DataFrame:
    """The ``n`` rows with ``rank``, 1 for the first in this order. No group or single task sees all of them.

    ``_at`` names a part of the sort, of which a file may hold several.
    """
    placed = stored(rows.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "ranked", n)
    part = F.shiftright("_at", PLACE_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # One row per part of the sorted table.
    front = F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("_part", F.coalesce(front, F.lit(0)).alias("_front"))
    joined = placed.withColumn("_part", part).join(broadcast_if_small(sizes, MANY_PARTS), "_part")
    place = F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return joined.withColumn("rank", F.col("_front") + place + 1).drop("_at", "_part", "_front")


def resample(docs: DataFrame, target: DataFrame, longest: int = 2, buckets: int = BUCKETS, percent: int = 25,
             least_words: int = 20, seed: int = 7) -> DataFrame:
    """All documents with n_words, n_features, weight, score, and the rank of those that are drawn.

    ``percent`` of the documents with at least ``least_words`` words are drawn,
    those with the highest scores; ties go to the smaller id.
    """
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets), buckets)
    n = docs.count()
    weighed = docs.select("doc_id", "text").mapInArrow(
        _weigh(gain, longest, seed), "doc_id BIGINT, n_words BIGINT, n_features BIGINT, weight BIGINT, score BIGINT")
    # The texts are read by as many tasks as they come in; their few numbers go to few files.
    scored = stored(weighed.repartition(n // ROWS_PER_FILE + 1), "weights")
    able = F.col("n_words") >= least_words
    n_able = scored.where(able).count()
    due = n_able * percent // 100
    in_order = ranked(scored.where(able), n_able, F.desc("score"), F.asc_nulls_last("doc_id"), "n_features", "weight")
    drawn = in_order.withColumn("rank", F.when(F.col("rank") <= due, F.col("rank")))
    return in_files(drawn.unionByName(scored.where(~able).withColumn("rank", F.lit(None).cast("long"))), n)
