"""Hierarchical Pitman-Yor language model with sampled seating.

Tokens are words and one end mark per text. Every scored text is a context with
a restaurant of its own, whose customers are the tokens of the text so far and
whose parent, shared by all texts, is the corpus restaurant. Its customers are
all training tokens. A new table there orders a spelling from the hierarchy
below it: restaurants for contexts of the last four, three, two, one and no
bytes, each the parent of all contexts that extend it, down to the uniform
distribution over bytes. The end mark is the word without a byte.

Seating is sampled by Gibbs sweeps. In a sweep every dish's customers are
seated anew, one after the other, by the Chinese-restaurant rule, given the
parent's predictive probability and the restaurant's other tables as the last
sweep left them; tables become customers of the parent. Given those, dishes are
independent, so the vocabulary is sampled in parallel, each word from random
numbers hashed from the word itself: retries and other partitionings agree.
Customers beyond the first ``EXACT`` of a dish are seated in doubling groups.
After ``BURN_IN`` sweeps the predictive probabilities of ``SAMPLES`` sweeps are
averaged.

What grows with the corpus (the vocabulary with its counts) stays in tables.
The bytes of a context beyond the last count as one of 33, 33 and 5 classes, so
there are at most 258 * 33 * 33 * 5 of the longest contexts whatever the corpus;
that table is held by the driver and sent to the tasks. Frequent words, at most
``FREQUENT``, are sent too; the other words of a text meet the vocabulary in a
join in which no word has many rows.

Defined results: null and empty texts have the end mark alone. Without training
text the model is the spelling model over uniform bytes and the base score is 0
per token. Equal rows each give a row. Texts and words may have any length. An
empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from overflight.llm.common import portions, remainder, stored, text_of

HELD_OUT = 2  # remainder modulo FOLDS
FOLDS = 7
BURN_IN, SAMPLES = 1, 2
EXACT = 32
FREQUENT = 200_000
COUNTED = 4 << 20  # bytes of texts whose words a task counts before it passes them on
STRENGTH = 1.0
TEXT_STRENGTH, TEXT_DISCOUNT = 100.0, 0.9  # of the restaurant each scored text has for itself
DISCOUNTS = (0.1, 0.3, 0.4, 0.5, 0.5)  # by bytes of context

END, START, SYMBOLS = 256, 257, 257
CLASSES = (1, 258, 33, 33, 5)  # of the byte that each level adds; the last class is the word's start
LEVELS = len(DISCOUNTS)


def tokens(text: str) -> list[bytes]:
    """Words with A-Z lower-cased, then the end mark (no bytes)."""
    found = text.encode("utf-8", "replace").lower().split()
    found.append(b"")
    return found


def numbered(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """``tokens`` of all texts, one after the other, as places in a list of words; that list; and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    found, text = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    real = pc.binary_length(found).to_numpy() > 0  # white space at an end of the text leaves an empty one
    listed = found.filter(pa.array(real)).dictionary_encode()
    size = np.bincount(text[real], minlength=len(texts))
    word = np.insert(listed.indices.to_numpy().astype(np.int64), np.cumsum(size), len(listed.dictionary))
    return word, pa.concat_arrays([listed.dictionary.cast(pa.binary()), pa.array([b""], pa.binary())]), size + 1


def _uniform(keys: np.ndarray, sweep: int, step: int) -> np.ndarray:
    x = keys + np.uint64((sweep * 1_000_003 + step) * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)


def seated(count: np.ndarray, parent: np.ndarray, pull: np.ndarray, discount: float, keys: np.ndarray, sweep: int) -> np.ndarray:
    """Tables of dishes with ``count`` customers; ``pull`` is strength + discount * tables of the restaurant."""
    tables = (count > 0).astype(np.float64)
    weight = pull * parent
    live = np.flatnonzero(count > 1)
    seats, step = 1, 0
    while len(live):
        group = np.ones(len(live)) if seats < EXACT else np.minimum(count[live] - seats, seats)
        w = weight[live]
        chance = w / (w + seats + (group - 1) / 2 - discount * tables[live])
        more = group * chance
        whole = np.floor(more)
        tables[live] += whole + (_uniform(keys[live], sweep, step) < more - whole)
        seats, step = (seats + 1 if seats < EXACT else 2 * seats), step + 1
        live = live[count[live] > seats]
    return np.minimum(tables, count)


def spelled(words: list[bytes]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For every symbol of the words: its context's number at each level, the symbol, and where each word starts."""
    length = np.fromiter(map(len, words), np.int64, len(words))
    first = np.cumsum(length + LEVELS) - (length + LEVELS)
    flat = np.full(int((length + LEVELS).sum()), START, np.int64)
    raw = np.frombuffer(b"".join(words), np.uint8)
    inside = np.arange(len(raw)) + np.repeat(first + LEVELS - 1 - (np.cumsum(length) - length), length)
    flat[inside] = raw
    flat[first + LEVELS - 1 + length] = END
    symbol = np.ones(len(flat), bool)
    symbol[(first[:, None] + np.arange(LEVELS - 1)).ravel()] = False
    at = np.flatnonzero(symbol)
    context = [np.zeros(len(at), np.int64), flat[at - 1]]
    for back in range(2, LEVELS):
        before = flat[at - back]
        last = CLASSES[back] - 1
        context.append(context[-1] * CLASSES[back] + np.where(before == START, last, before % last))
    return context, flat[at], np.cumsum(length + 1) - (length + 1)


def _parent(restaurant: np.ndarray, level: int) -> np.ndarray:
    return restaurant // CLASSES[level] if level > 1 else np.zeros_like(restaurant)


@dataclass
class Spelling:
    """The byte restaurants: predictive probabilities of served dishes and what each restaurant leaves to its parent."""

    dishes: list[np.ndarray] = field(default_factory=lambda: [np.empty(0, np.int64)] * LEVELS)
    chance: list[np.ndarray] = field(default_factory=lambda: [np.empty(0)] * LEVELS)
    restaurants: list[np.ndarray] = field(default_factory=lambda: [np.empty(0, np.int64)] * LEVELS)
    left: list[np.ndarray] = field(default_factory=lambda: [np.empty(0)] * LEVELS)

    def probability(self, context: list[np.ndarray], symbol: np.ndarray, level: int = LEVELS - 1) -> np.ndarray:
        out, factor, todo = np.empty(len(symbol)), np.ones(len(symbol)), np.arange(len(symbol))
        for depth in range(level, -1, -1):
            place, found = _find(self.dishes[depth], context[depth][todo] * SYMBOLS + symbol[todo])
            out[todo[found]] = factor[found] * self.chance[depth][place[found]]
            todo, factor = todo[~found], factor[~found]
            place, known = _find(self.restaurants[depth], context[depth][todo])
            factor[known] *= self.left[depth][place[known]]
        out[todo] = factor / SYMBOLS
        return out

    def log_words(self, words: list[bytes]) -> np.ndarray:
        """Natural log probability of the spellings."""
        if not words:
            return np.empty(0)
        context, symbol, first = spelled(words)
        dish, place = np.unique(context[-1] * SYMBOLS + symbol, return_inverse=True)  # words share most of them
        context = [dish // SYMBOLS]
        for level in range(LEVELS - 1, 0, -1):
            context.insert(0, _parent(context[0], level))
        return np.add.reduceat(np.log(self.probability(context, dish % SYMBOLS))[place], first)


def _find(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    place = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
    return place, sorted_keys[place] == wanted


def resampled(dishes: np.ndarray, customers: np.ndarray, last: Spelling, sweep: int) -> Spelling:
    """Seat the byte restaurants anew from the spellings that were ordered, deepest context first."""
    seats = []
    for level in range(LEVELS - 1, -1, -1):
        restaurant, symbol = dishes // SYMBOLS, dishes % SYMBOLS
        up = _parent(restaurant, level)
        context = [np.zeros(len(up), np.int64)] * LEVELS
        if level:
            context[level - 1], above = up, up
            for upper in range(level - 1, 0, -1):
                above = _parent(above, upper)
                context[upper - 1] = above
            parent = last.probability(context, symbol, level - 1)
        else:
            parent = np.full(len(dishes), 1 / SYMBOLS)
        names, place = np.unique(restaurant, return_inverse=True)
        pull = STRENGTH + DISCOUNTS[level] * np.bincount(place, minlength=len(names))
        keys = dishes.astype(np.uint64) * np.uint64(LEVELS) + np.uint64(level)
        tables = seated(customers, parent, pull[place], DISCOUNTS[level], keys, sweep)
        seats.append((level, dishes, customers, tables, names, place, up, symbol))
        dishes, inverse = np.unique(up * SYMBOLS + symbol, return_inverse=True)
        customers = np.bincount(inverse, weights=tables, minlength=len(dishes))
    model = Spelling([None] * LEVELS, [None] * LEVELS, [None] * LEVELS, [None] * LEVELS)
    for level, dishes, customers, tables, names, place, up, symbol in reversed(seats):
        base = np.full(len(dishes), 1 / SYMBOLS) if level == 0 else \
            model.chance[level - 1][np.searchsorted(model.dishes[level - 1], up * SYMBOLS + symbol)]
        all_customers = np.bincount(place, weights=customers, minlength=len(names))
        pull = STRENGTH + DISCOUNTS[level] * np.bincount(place, weights=tables, minlength=len(names))
        model.dishes[level], model.restaurants[level] = dishes, names
        model.left[level] = pull / (STRENGTH + all_customers)
        model.chance[level] = (customers - DISCOUNTS[level] * tables + pull[place] * base) / (STRENGTH + all_customers)[place]
    return model


@dataclass
class Sample:
    """State of a sweep: the spelling model the words saw and the tables of the word restaurant."""

    sweep: int
    spelling: Spelling
    tables: float


@dataclass
class Model:
    total: int  # training tokens
    distinct: int
    discount: float
    samples: list[Sample]

    def word_tables(self, words: list[bytes], count: np.ndarray, log_base: np.ndarray, sample: Sample) -> np.ndarray:
        keys = np.fromiter((zlib.crc32(w) << 32 | zlib.adler32(w) for w in words), np.uint64, len(words))
        pull = np.full(len(words), STRENGTH + self.discount * sample.tables)
        return seated(count, np.exp(log_base), pull, self.discount, keys, sample.sweep)

    def log10_words(self, words: list[bytes], count: np.ndarray) -> np.ndarray:
        """log10 of the predictive probability, averaged over the samples."""
        out = []
        for s in self.samples:
            base = s.spelling.log_words(words)
            tables = self.word_tables(words, count, base, s)
            rest = np.log((STRENGTH + self.discount * s.tables) / (STRENGTH + self.total)) + base
            with np.errstate(divide="ignore"):
                own = np.log(np.maximum(count - self.discount * tables, 0) / (STRENGTH + self.total))
            out.append(np.logaddexp(own, rest))
        return (np.logaddexp.reduce(out, axis=0) - np.log(len(out))) / np.log(10)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in portions(batches, "text", COUNTED):
        word, names, size = numbered(batch.column("text"))
        held = np.repeat(batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool), size)
        yield pa.RecordBatch.from_pydict({
            "word": names, "train": np.bincount(word[~held], minlength=len(names)), "held": np.bincount(word[held], minlength=len(names))})


def vocabulary(texts: DataFrame) -> DataFrame:
    """``word, train, seen``: occurrences in training texts and in all texts."""
    return texts.select("text", "held_out").mapInArrow(_counted, "word BINARY, train BIGINT, held BIGINT") \
        .groupBy("word").agg(F.sum("train").alias("train"), F.sum(F.col("train") + F.col("held")).alias("seen"))


def _swept(model: Model, sent, sweep: int, tables: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample, ordered = Sample(sweep, sent.value, tables), Counter()
        for batch in portions(batches, "word"):
            words = batch.column("word").to_pylist()
            count = batch.column("train").to_numpy(zero_copy_only=False).astype(np.float64)
            got = model.word_tables(words, count, sample.spelling.log_words(words), sample)
            context, symbol, first = spelled(words)
            each = np.diff(np.append(first, len(symbol)))
            dish, place = np.unique(context[-1] * SYMBOLS + symbol, return_inverse=True)
            sums = np.bincount(place, weights=np.repeat(got, each), minlength=len(dish))
            ordered.update(dict(zip(dish.tolist(), sums.tolist())))
            ordered[-1] += float(got.sum())
        if ordered:
            yield pa.RecordBatch.from_pydict({
                "dish": pa.array(ordered.keys(), pa.int64()), "n": pa.array(ordered.values(), pa.float64())})

    return run


def swept(known: DataFrame, model: Model, spelling: Spelling, sweep: int, tables: float) -> tuple[Spelling, float]:
    """A sweep over the customers of the corpus restaurant (``word, train``): the bytes' seating and the words' tables."""
    sent = known.sparkSession.sparkContext.broadcast(spelling)
    ordered = known.mapInArrow(_swept(model, sent, sweep, tables), "dish BIGINT, n DOUBLE") \
        .groupBy("dish").agg(F.sum("n").alias("n")).toArrow().sort_by("dish")  # one row per byte of a restaurant at most
    sent.destroy()
    dish, n = ordered["dish"].to_numpy(), ordered["n"].to_numpy()
    return resampled(dish[dish >= 0], n[dish >= 0], spelling, sweep), float(n[dish == -1].sum())


def fit(words: DataFrame, burn_in: int = BURN_IN, samples: int = SAMPLES) -> Model:
    """Sample the seating from a stored vocabulary."""
    known = words.where("train > 0").select("word", "train")
    total, distinct, once, twice = known.agg(
        F.coalesce(F.sum("train"), F.lit(0)), F.count("*"), F.count(F.when(F.col("train") == 1, 1)),
        F.count(F.when(F.col("train") == 2, 1))).first()
    discount = min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5
    model = Model(total, distinct, discount, [])
    spelling, tables = Spelling(), float(distinct)
    for sweep in range(burn_in + samples if distinct else 0):
        spelling, tables = swept(known, model, spelling, sweep, tables)
        if sweep >= burn_in:
            model.samples.append(Sample(sweep + 1, spelling, tables))
    if not model.samples:
        model.samples.append(Sample(0, spelling, tables))
    return model


def _word_scores(sent) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in portions(batches, "word"):
            words = batch.column("word").to_pylist()
            count = batch.column("train").to_numpy(zero_copy_only=False).astype(np.float64)
            yield pa.RecordBatch.from_pydict({
                "word": batch.column("word").cast(pa.binary()), "train": batch.column("train"), "seen": batch.column("seen"),
                "score": pa.array(model.log10_words(words, count), pa.float64())})

    return run


def _own_seating(words: list[bytes]) -> tuple[dict[bytes, int], np.ndarray, np.ndarray, np.ndarray]:
    """The text's own restaurant: its dishes by number, each token's dish, and (a, b) with P = a + b * P_corpus.

    A dish has one table. The first of its customers comes by the parent
    (a = 0), later ones join with what the discount leaves.
    """
    dishes: dict[bytes, int] = {}
    dish = np.fromiter((dishes.setdefault(w, len(dishes)) for w in words), np.int64, len(words))
    seated_before = np.arange(len(words))
    tables = np.concatenate(([0], np.maximum.accumulate(dish)[:-1] + 1))
    order = np.argsort(dish, kind="stable")
    size = np.bincount(dish)
    earlier = np.empty(len(words), np.int64)
    earlier[order] = seated_before - np.repeat(np.cumsum(size) - size, size)
    a = np.where(earlier > 0, earlier - TEXT_DISCOUNT, 0) / (TEXT_STRENGTH + seated_before)
    b = (TEXT_STRENGTH + TEXT_DISCOUNT * tables) / (TEXT_STRENGTH + seated_before)
    return dishes, dish, a, b


_PART = pa.schema([
    ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("held_out", pa.bool_()), ("word", pa.binary()), ("times", pa.int32()),
    ("again", pa.list_(pa.float64())),
    ("own", pa.struct([("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())]))])
_PART_SQL = ("doc_id BIGINT, text_hash BIGINT, held_out BOOLEAN, word BINARY, times INT, again ARRAY<DOUBLE>, "
             "own STRUCT<n_tokens: BIGINT, n_known: BIGINT, base: DOUBLE, score: DOUBLE>")


@dataclass
class Frequent:
    """Words sent to the tasks with what each adds to a text's sums."""

    number: dict[bytes, int]
    known: np.ndarray
    base: np.ndarray
    score: np.ndarray


def _parts(sent) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per text one row per other word; the first row has the sums over everything known here.

    ``again`` lists a and b of the word's second and later places, one after
    the other. A text without other words has a row for a word that cannot
    exist (it has a space).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = sent.value
        for batch in portions(batches, "text"):
            columns = {name: [] for name in _PART.names}
            for doc, key, held, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "held_out", "text"))):
                words = tokens(text)
                dishes, dish, a, b = _own_seating(words)
                number = np.fromiter(map(frequent.number.get, dishes, repeat(-1)), np.int64, len(dishes))
                here = number >= 0
                times = np.bincount(dish)
                token = number[dish]
                first, known = a == 0, token >= 0
                again = known & ~first
                own = {
                    "n_tokens": len(words),
                    "n_known": int((frequent.known[number[here]] * times[here]).sum()),
                    "base": float((frequent.base[number[here]] * times[here]).sum()),
                    "score": float(np.log10(b[first]).sum() + frequent.score[number[here]].sum()
                                   + np.log10(a[again] + b[again] * 10 ** frequent.score[token[again]]).sum()),
                }
                more: dict[int, list[float]] = {}
                for i in np.flatnonzero(~known & ~first):
                    more.setdefault(int(dish[i]), []).extend((a[i], b[i]))
                listed = list(dishes)
                rest = [(listed[i], int(times[i]), more.get(int(i))) for i in np.flatnonzero(~here)]
                rest = rest or [(b" %d %d" % (key, doc or 0), 0, None)]
                n = len(rest)
                for name, values in zip(_PART.names, ([doc] * n, [key] * n, [held] * n, *zip(*rest), [own] + [None] * (n - 1))):
                    columns[name] += values
            yield pa.RecordBatch.from_pydict(columns, schema=_PART)

    return run


def _threshold(words: DataFrame, most: int) -> int:
    """The smallest number of occurrences that at most ``most`` words reach."""
    top = 1 << 20
    steps = words.groupBy(F.least("seen", F.lit(top)).alias("seen")).agg(F.count("*").alias("n"))
    running = 0
    for r in steps.orderBy(F.desc("seen")).limit(most + 1).collect():
        running += r["n"]
        if running > most:
            return r["seen"] + 1
    return 1


def scored(docs: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    spark = docs.sparkSession
    texts = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), text_of().alias("text"),
        (remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"))
    words = stored(vocabulary(texts), "vocabulary")
    model = fit(words)
    words = stored(words.mapInArrow(_word_scores(spark.sparkContext.broadcast(model)),
                                    "word BINARY, train BIGINT, seen BIGINT, score DOUBLE"), "word-scores")
    base = F.log10((F.col("train") + 1) / F.lit(float(model.total + model.distinct + 1)))
    words = words.withColumn("base", base)
    least = _threshold(words, frequent)
    listed = words.where(F.col("seen") >= least).select("word", "train", "base", "score").toArrow()  # at most ``frequent`` rows
    sent = spark.sparkContext.broadcast(Frequent(
        {w.as_py(): i for i, w in enumerate(listed["word"])}, listed["train"].to_numpy() > 0, listed["base"].to_numpy(),
        listed["score"].to_numpy()))
    del listed

    parts = texts.mapInArrow(_parts(sent), _PART_SQL)
    rare = words.where(F.col("seen") < least).select("word", "train", "base", "score")
    joined = parts.join(rare, "word", "left")
    # log10(a + b * P) over the pairs of ``again``.
    later = F.expr("""aggregate(sequence(0, size(again) DIV 2 - 1), 0D,
        (total, i) -> total + log10(get(again, 2 * i) + get(again, 2 * i + 1) * pow(10D, score)))""")
    later = F.when(F.col("again").isNotNull(), later)
    sums = joined.groupBy("doc_id", "text_hash", "held_out").agg(
        F.count("own").alias("copies"),
        F.sum("own.n_tokens").alias("n_tokens"),
        F.sum(F.coalesce("own.n_known", F.lit(0)) + F.when(F.col("train") > 0, F.col("times")).otherwise(0)).alias("n_known"),
        F.sum(F.coalesce("own.base", F.lit(0.0)) + F.coalesce(F.col("times") * F.col("base"), F.lit(0.0))).alias("base"),
        F.sum(F.coalesce("own.score", F.lit(0.0)) + F.coalesce("score", F.lit(0.0)) + F.coalesce(later, F.lit(0.0))).alias("score"),
    )
    return per_row(sums, model.total)


def per_row(sums: DataFrame, total: int) -> DataFrame:
    """A row for each of the equal rows whose sums these are."""
    whole = lambda name: (F.col(name) / F.col("copies")).cast("long").alias(name)
    return sums.select(
        "doc_id", "held_out", whole("n_tokens"), whole("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("copies")).alias("base_score"), (F.col("score") / F.col("copies")).alias("score"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).drop("copy")


def perplexity(scores: DataFrame) -> DataFrame:
    """Per token, by fold, under the model and the base: one row for each value of held_out."""
    per_token = lambda name: F.pow(F.lit(10.0), -F.sum(name) / F.sum("n_tokens"))
    return scores.groupBy("held_out").agg(per_token("score").alias("perplexity"), per_token("base_score").alias("base_perplexity"))
