"""Hierarchical Pitman-Yor language model with restaurants for the previous word.

Below the text's own restaurant of ``hpylm`` every word of the training texts
has a restaurant for what follows it; its parent is the corpus restaurant,
whose customers are the tables of all of them, and the bytes lie below that as
before. The end mark is also the context of a text's first token.

Tables are sampled like those of ``hpylm``: a sweep seats the corpus and the
bytes anew, then all pairs of words, each given its parent's predictive
probability and its restaurant's tables. Random numbers are hashed from the two
words. A pair that occurs once has one table, so customers less tables
(``spare``) differ from nothing only for pairs that occur again: only those are
stored and seated, and what a word has as context or as dish is its count less
the spare customers.

    P(word | previous) = mean of (count - d * tables + (s + d * all tables) * P(word)) / (s + all customers)

Words go by a key: frequent ones by a number, others by 63 bits of a digest, so
words of equal digest would share their places (below one in a hundred for some
pair of 300 million words). A pair of frequent words goes by its exact place
among all, any other by 62 bits mixed from both keys, with the same reservation.
What is seated follows from the pairs and from figures of both words, so only
pairs are stored, no seats. A text gets the figures of its rare words by a join
and a grouping. The most frequent pairs of frequent words, at most ``PAIRS``, are
sent to the tasks too; each other place meets the stored pairs. Pairs are counted
and met in blocks: sorted, packed codes of many places in a row, grouped by a
hash of the code into parts of about ``IN_PART`` places; a task merges a part.
Null and empty texts, equal rows and missing training text are treated as in
``hpylm``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import cached_property, partial, reduce
from hashlib import blake2b
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from overflight.llm import hpylm
from overflight.llm.common import portions, remainder, stored, text_of
from overflight.llm.hpylm import BURN_IN, FOLDS, FREQUENT, HELD_OUT, SAMPLES, Sample, Spelling

STRENGTH = 1.0  # of the restaurant of a previous word
PAIRS = 2_500_000  # of frequent words, sent to the tasks
PAIRED = 2 << 20  # bytes of texts whose pairs a task counts before it passes them on
SCORED = 1 << 20  # bytes of texts a task scores at once
TURNS = 3  # the texts are scored in, so that only a share of them lies shuffled at a time
IN_PART = 4_000_000  # places of a part, in which pairs are counted or met
LN10 = np.log(10)
Batches = Iterator[pa.RecordBatch]


def _keys(words: list[bytes], number: dict[bytes, int]) -> np.ndarray:
    """The word's number, or a negative number from its digest."""
    found = map(number.get, words, repeat(-1))
    return np.fromiter((n if n >= 0 else _digest(w) for n, w in zip(found, words)), np.int64, len(words))


def _digest(word: bytes) -> int:
    return int.from_bytes(blake2b(word, digest_size=8).digest(), "little", signed=True) | -(1 << 63)


def _keyed(sent) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in portions(batches, "word"):
            yield batch.append_column("key", pa.array(_keys(batch.column("word").to_pylist(), sent.value)))

    return run


def _codes(u: np.ndarray, w: np.ndarray, words: int) -> np.ndarray:
    """A pair of the ``words`` frequent words by its place among all such pairs, any other by a negative number of 62 bits."""
    mixed = (u.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ w.view(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return np.where((u >= 0) & (w >= 0), u * words + w, -1 - (mixed >> np.uint64(2)).astype(np.int64))


def _parts(code: np.ndarray, parts: int) -> np.ndarray:
    return ((code.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(33)).astype(np.int64) % parts


def _packed(values: np.ndarray) -> bytes:
    """Byte by byte of all values, so that the upper bytes of small numbers compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def _unpacked(packed: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _steps(ascending: np.ndarray) -> np.ndarray:
    return np.diff(ascending, prepend=np.int64(0))


def _blocks(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each part with the places of its rows, in order."""
    order = np.argsort(part.astype(np.min_scalar_type(int(part.max(initial=0)))), kind="stable")  # quick for small numbers
    names, first = np.unique(part[order], return_index=True)
    return zip(names.tolist(), np.split(order, first[1:]))


def _paired(sent, parts: int) -> Callable[[Batches], Batches]:
    """Pairs of many texts as one row per part: codes in ascending order, doubled and one more if held out, and
    how often; of pairs with other than frequent words (they come first) also both keys."""

    def run(batches: Batches) -> Batches:
        number = sent.value
        for batch in portions(batches, "text", PAIRED):
            word, names, size = hpylm.numbered(batch.column("text"))
            w = _keys(names.to_pylist(), number)[word]
            u = np.roll(w, 1)  # of a first token: the end mark of the text before it
            code = _codes(u, w, len(number)) * 2 + np.repeat(batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool), size)
            rare = code < 0
            plain, n = np.unique(code[~rare], return_counts=True)
            other, at, m = np.unique(code[rare], return_index=True, return_counts=True)
            code, n = np.concatenate((other, plain)), np.concatenate((m, n))
            u, w = u[rare][at], w[rare][at]
            got = []
            for part, at in _blocks(_parts(code >> 1, parts)):
                few = at[:np.searchsorted(at, len(other))]
                got.append((part, _packed(_steps(code[at])), _packed(n[at]), _packed(u[few]), _packed(w[few])))
            part, *columns = zip(*got)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), *(pa.array(c, pa.binary()) for c in columns)], ["part", "code", "n", "u", "w"])

    return run


def _merged(words: int) -> Callable[[pa.Table], pa.Table]:
    """Sums over the blocks of a part: pairs in training texts that occur at another place too."""

    def counted(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.argsort(code, kind="stable")
        code, n = code[order], n[order]
        first = np.flatnonzero(np.append(True, code[1:] >> 1 != code[:-1] >> 1)[:len(code)])
        seen = np.add.reduceat(n, first) if len(n) else n
        train = np.add.reduceat(np.where(code & 1, 0, n), first) if len(n) else n
        again = (train > 0) & (seen > 1)
        return order[first[again]], code[first[again]] >> 1, train[again]

    def run(table: pa.Table) -> pa.Table:
        code = [np.cumsum(_unpacked(c, np.int64)) for c in table["code"].to_pylist()]
        n = [_unpacked(c, np.int64) for c in table["n"].to_pylist()]
        rare = [int(np.searchsorted(c, 0)) for c in code]
        both = lambda name: np.concatenate([_unpacked(c, np.int64) for c in table[name].to_pylist()])
        at, _, train = counted(*(np.concatenate([v[:r] for v, r in zip(vs, rare)]) for vs in (code, n)))
        _, plain, more = counted(*(np.concatenate([v[r:] for v, r in zip(vs, rare)]) for vs in (code, n)))
        return pa.table({
            "u": np.concatenate((both("u")[at], plain // max(words, 1))), "w": np.concatenate((both("w")[at], plain % max(words, 1))),
            "train": np.concatenate((train, more))})

    return run


def pair_counts(texts: DataFrame, sent, words: int, parts: int) -> DataFrame:
    """``u, w, train``: pairs of neighbours in training texts that occur at another place too, held-out texts included."""
    return texts.select("text", "held_out") \
        .mapInArrow(_paired(sent, parts), "part INT, code BINARY, n BINARY, u BINARY, w BINARY") \
        .groupBy("part").applyInArrow(_merged(words), "u BIGINT, w BIGINT, train BIGINT")


def discount_of(once: int, twice: int) -> float:
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5


def _chances(sent) -> Callable[[Batches], Batches]:
    """Predictive probability of each word in the corpus restaurant."""

    def run(batches: Batches) -> Batches:
        for batch in portions(batches, "word"):
            customers = batch.column("customers").to_numpy(zero_copy_only=False).astype(np.float64)
            chance = 10 ** sent.value.log10_words(batch.column("word").to_pylist(), customers)
            yield pa.RecordBatch.from_pydict(
                {**{c: batch.column(c) for c in ("key", "seed", "tables")}, "chance": pa.array(chance, pa.float64())})

    return run


def _reseated(discount: float, sweep: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            u_seed, w_seed, chance, tables, train, kept = _columns(batch, "u_seed", "w_seed", "chance", "tables", "train", "kept")
            spare = _spare(u_seed, w_seed, chance, tables, train, discount, sweep)
            yield pa.RecordBatch.from_pydict({**{c: batch.column(c) for c in ("u", "w", "train")}, "spare": spare, "kept": kept + spare})

    return run


def _columns(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False) for n in names]


def _spare(u_seed, w_seed, chance, tables, train, discount: float, sweep: int) -> np.ndarray:
    keys = u_seed.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + w_seed.view(np.uint64)
    count = train.astype(np.float64)
    return (count - hpylm.seated(count, chance, STRENGTH + discount * tables, discount, keys, sweep)).astype(np.int64)


def _seats(pairs: DataFrame, state: DataFrame, discount: float, sweep: int) -> DataFrame:
    """``spare`` of each pair in a sweep, added to ``kept``."""
    chances = state.select(F.col("key").alias("w"), F.col("seed").alias("w_seed"), "chance")
    contexts = state.select(F.col("key").alias("u"), F.col("seed").alias("u_seed"), "tables")
    return pairs.join(chances, "w").join(contexts, "u") \
        .mapInArrow(_reseated(discount, sweep), "u BIGINT, w BIGINT, train BIGINT, spare BIGINT, kept BIGINT")


@dataclass
class Seating:
    """What a sweep knows of frequent words, by number."""

    sweep: int
    chance: np.ndarray
    tables: np.ndarray
    seed: np.ndarray

    @staticmethod
    def of(state: DataFrame, sweep: int) -> Seating:
        got = state.where("key >= 0").toArrow()  # at most ``frequent`` rows
        key = got["key"].to_numpy()
        size = int(key.max()) + 1 if len(key) else 0
        out = Seating(sweep, np.zeros(size), np.zeros(size), np.zeros(size, np.int64))
        for name in ("chance", "tables", "seed"):
            getattr(out, name)[key] = got[name].to_numpy()
        return out

    def spare(self, u: np.ndarray, w: np.ndarray, train: np.ndarray, discount: float) -> np.ndarray:
        return _spare(self.seed[u], self.seed[w], self.chance[w], self.tables[u], train, discount, self.sweep)


def _spare_of_words(sent, discount: float, words: int) -> Callable[[Batches], Batches]:
    """Spare customers of frequent words in pairs of them, per task; without a seating, all but the first customer."""

    def run(batches: Batches) -> Batches:
        seating = sent and sent.value
        of_context, of_dish = np.zeros(words), np.zeros(words)
        for batch in batches:
            u, w, train = _columns(batch, "u", "w", "train")
            spare = seating.spare(u, w, train, discount) if seating else train - 1
            of_context += np.bincount(u, weights=spare, minlength=words)
            of_dish += np.bincount(w, weights=spare, minlength=words)
        key = np.flatnonzero((of_context > 0) | (of_dish > 0))
        yield pa.RecordBatch.from_pydict({
            "key": key, "of_context": of_context[key].astype(np.int64), "of_dish": of_dish[key].astype(np.int64)})

    return run


def _valued(sent, discount: float) -> Callable[[Batches], Batches]:
    """x of pairs of frequent words: customers less discounted tables, averaged over the seatings."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            u, w, train = _columns(batch, "u", "w", "train")
            kept = sum((s.spare(u, w, train, discount) for s in sent.value), np.zeros(len(u), np.int64))
            x = train - discount * (train - kept / max(len(sent.value), 1))
            yield pa.RecordBatch.from_pydict({**{c: batch.column(c) for c in ("u", "w", "train")}, "x": x})

    return run


def _by_word(seats: DataFrame, here: DataFrame) -> DataFrame:
    """``key, of_context, of_dish``: spare customers in the word's own restaurant, and of the word in all restaurants;
    ``here`` has those of pairs of frequent words."""
    none = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("u").alias("key"), F.col("spare").alias("of_context"), none.alias("of_dish")),
        F.struct(F.col("w").alias("key"), none.alias("of_context"), F.col("spare").alias("of_dish")))
    return seats.where("spare > 0").select(F.inline(sides)).unionByName(here) \
        .groupBy("key").agg(F.sum("of_context").alias("of_context"), F.sum("of_dish").alias("of_dish"))


@dataclass
class Fitted:
    total: int  # training tokens
    distinct: int
    discount: float  # of the restaurants of previous words
    corpus: list[hpylm.Model]  # one for each kept sample
    spare: list[DataFrame]
    pairs: DataFrame  # u, w, train, x: customers less discounted tables, averaged over the samples
    sent: list = field(default_factory=list)  # broadcasts of the figures

    @property
    def of_base(self) -> float:
        return float(self.total + self.distinct + 1)


def fit(words: DataFrame, pairs: DataFrame, burn_in: int = BURN_IN, samples: int = SAMPLES) -> Fitted:
    """Sample the seating from stored words (``word, key, train, seen``) and pairs."""
    total, distinct = words.where("train > 0").agg(F.coalesce(F.sum("train"), F.lit(0)), F.count("*")).first()
    twice, again = pairs.where("train > 1").agg(F.count_if(F.col("train") == 2), F.coalesce(F.sum("train"), F.lit(0))).first()
    discount = discount_of(total - again, twice)
    both = (F.col("u") >= 0) & (F.col("w") >= 0)
    context, frequent = words.sparkSession.sparkContext, words.agg(F.coalesce(F.max("key"), F.lit(-1))).first()[0] + 1
    frequent, plain = max(frequent, 0), pairs.where(both)

    def spare_here(sent) -> DataFrame:
        return plain.mapInArrow(_spare_of_words(sent, discount, frequent), "key BIGINT, of_context BIGINT, of_dish BIGINT")

    others = pairs.where(~both).withColumn("kept", F.lit(0).cast("long"))
    spare = stored(_by_word(others.withColumn("spare", F.col("train") - 1), spare_here(None)), "spare-customers")
    seatings, states = [], []
    counted = words.where("train > 0").withColumn("seed", F.xxhash64("word"))

    def restaurants() -> DataFrame:
        part = lambda name: F.col("train") - F.coalesce(name, F.lit(0))
        return counted.join(spare, "key", "left").select(
            "word", "key", "seed", "seen", part("of_context").alias("tables"), part("of_dish").alias("customers"))

    once_0, twice_0 = restaurants().agg(F.count_if(F.col("customers") == 1), F.count_if(F.col("customers") == 2)).first()
    corpus_discount = discount_of(once_0, twice_0)

    def corpus(sample: list[Sample]) -> hpylm.Model:
        customers = total - spare.agg(F.coalesce(F.sum("of_dish"), F.lit(0))).first()[0]
        return hpylm.Model(customers, distinct, corpus_discount, sample)

    spelling, tables = Spelling(), float(distinct)
    fitted = Fitted(total, distinct, discount, [], [], None)
    for sweep in range(burn_in + samples if distinct else 0):
        customers = restaurants().select("word", F.col("customers").alias("train"))
        spelling, tables = hpylm.swept(customers, corpus([]), spelling, sweep, tables)
        sample = Sample(sweep + 1, spelling, tables)
        sent = context.broadcast(corpus([sample]))
        state = stored(
            restaurants().where("seen > 1").select("word", "key", "seed", "customers", "tables").mapInArrow(
                _chances(sent), "key BIGINT, seed BIGINT, tables BIGINT, chance DOUBLE"), "word-chances")
        sent.destroy()  # or every executor keeps a copy on its disk
        seating = Seating.of(state, sweep)
        sent = context.broadcast(seating)
        spare = stored(_by_word(_seats(others, state, discount, sweep), spare_here(sent)), "spare-customers")
        sent.destroy()
        if sweep >= burn_in:
            states.append((state, sweep))
            seatings.append(seating)
            fitted.corpus.append(corpus([sample]))
            fitted.spare.append(spare)
    if not fitted.corpus:
        fitted.corpus.append(corpus([Sample(0, spelling, tables)]))
        fitted.spare.append(spare)
    tables_of = F.col("train") - F.col("kept") / len(fitted.corpus)
    for state, sweep in states:
        others = _seats(others, state, discount, sweep)
    others = others.select("u", "w", "train", (F.col("train") - discount * tables_of).alias("x"))
    fitted.pairs = others.unionByName(
        plain.mapInArrow(_valued(context.broadcast(seatings), discount), "u BIGINT, w BIGINT, train BIGINT, x DOUBLE"))
    return fitted


def _figures(sent, discount: float) -> Callable[[Batches], Batches]:
    """Per word and sample: ``chance``, ln P in the corpus, and ``pull``, ln of what its own restaurant leaves to that."""

    def run(batches: Batches) -> Batches:
        models = sent.value
        for batch in portions(batches, "word"):
            words = batch.column("word").to_pylist()
            per_sample = lambda name: batch.column(name).flatten().to_numpy().astype(np.float64).reshape(len(words), len(models))
            customers, tables = per_sample("customers"), per_sample("tables")
            chance = np.stack([m.log10_words(words, customers[:, i]) * LN10 for i, m in enumerate(models)], axis=1)
            lists = lambda values: pa.FixedSizeListArray.from_arrays(values.ravel(), len(models)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_pydict({
                **{c: batch.column(c) for c in ("key", "train", "seen", "base", "tables")},
                "chance": lists(chance), "pull": lists(_pull(tables, discount))})

    return run


def _pull(tables: np.ndarray, discount: float) -> np.ndarray:
    return np.log((STRENGTH + discount * tables) / tables.shape[1])


def word_figures(words: DataFrame, fitted: Fitted) -> DataFrame:
    joined = words
    for i, spare in enumerate(fitted.spare):
        joined = joined.join(spare.select("key", F.col("of_context").alias(f"c{i}"), F.col("of_dish").alias(f"d{i}")), "key", "left")
    left = lambda side: F.array(*(F.col("train") - F.coalesce(f"{side}{i}", F.lit(0)) for i in range(len(fitted.spare))))
    base = F.log10((F.col("train") + 1) / F.lit(fitted.of_base))
    sent = words.sparkSession.sparkContext.broadcast(fitted.corpus)
    fitted.sent.append(sent)
    return joined.select("word", "key", "train", "seen", base.alias("base"), left("c").alias("tables"), left("d").alias("customers")) \
        .mapInArrow(_figures(sent, fitted.discount), "key BIGINT, train BIGINT, seen BIGINT, base DOUBLE, tables ARRAY<BIGINT>, "
                    "chance ARRAY<DOUBLE>, pull ARRAY<DOUBLE>")


@dataclass
class Figures:
    """What a task knows of words: keys in ascending order with the columns of ``word_figures``."""

    key: np.ndarray
    train: np.ndarray
    seen: np.ndarray
    base: np.ndarray
    chance: np.ndarray
    pull: np.ndarray

    @staticmethod
    def of(table: pa.Table, samples: int) -> Figures:
        flat = lambda name: table[name].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, samples)
        return Figures(*(table[n].to_numpy() for n in ("key", "train", "seen", "base")), flat("chance"), flat("pull"))

    @staticmethod
    def packed(samples: int) -> Callable[[Batches], Batches]:
        """Rows without what follows from the rest."""

        def run(batches: Batches) -> Batches:
            for batch in batches:
                flat = lambda name: batch.column(name).flatten().to_numpy().reshape(-1, samples)
                key, train, seen = _columns(batch, "key", "train", "seen")
                rows = np.column_stack((key, train, seen, flat("tables"), flat("chance").view(np.int64)))
                width = rows.shape[1] * 8
                packed = pa.Array.from_buffers(pa.binary(width), len(rows), [None, pa.py_buffer(np.ascontiguousarray(rows))])
                yield pa.RecordBatch.from_pydict({"key": batch.column("key"), "figures": packed.cast(pa.binary())})

        return run

    @staticmethod
    def unpacked(rows: pa.Array, samples: int, discount: float, total: float) -> Figures:
        table = np.frombuffer(b"".join(rows.to_pylist()), np.int64).reshape(-1, 3 + 2 * samples)
        key, train, seen = table[:, :3].T
        return Figures(key, train, seen, np.log10((train + 1) / total), np.ascontiguousarray(table[:, 3 + samples:]).view(np.float64),
                       _pull(table[:, 3:3 + samples], discount))

    def rows(self, at) -> Figures:
        return Figures(self.key[at], self.train[at], self.seen[at], self.base[at], self.chance[at], self.pull[at])

    def with_rows(self, at: np.ndarray, other: Figures) -> Figures:
        for mine, theirs in zip(vars(self).values(), vars(other).values()):
            mine[at] = theirs
        return self


@dataclass
class Pairs:
    """Pairs of frequent words that a task knows, in ascending order, as small as they can be sent."""

    first: np.ndarray  # by previous word, the place of its first pair; then the number of pairs
    word: np.ndarray
    which: np.ndarray  # of ``values``: x is made of whole numbers, so few differ
    values: np.ndarray
    whole: bool  # there are no others of frequent words

    @property
    def words(self) -> int:
        return len(self.first) - 1

    @cached_property
    def code(self) -> np.ndarray:
        return np.repeat(np.arange(self.words) * self.words, np.diff(self.first)) + self.word

    def met(self, before: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By place: is its pair known here, its x if so, and may it be among the stored pairs."""
        both = (before >= 0) & (word >= 0)
        asked, back = np.unique(np.where(both, before * self.words + word, -1), return_inverse=True)  # neighbours are near in memory
        place, known = (found[back] for found in hpylm._find(self.code, asked))
        return known, self.values[self.which[place[known]]], ~(both if self.whole else known)


def sent_pairs(pairs: DataFrame, words: int, most: int) -> tuple[Pairs, DataFrame]:
    """The most frequent pairs of the ``words`` frequent words, at most ``most``, and all other pairs."""
    both = (F.col("u") >= 0) & (F.col("w") >= 0)
    least = hpylm._threshold(pairs.where(both).select(F.col("train").alias("seen")), most)
    sent = both & (F.col("train") >= least)
    listed = pairs.where(sent).select((F.col("u") * words + F.col("w")).alias("code"), "x").toArrow()  # at most ``most`` rows
    listed = listed.sort_by("code")
    code = listed["code"].to_numpy()
    values, which = np.unique(listed["x"].to_numpy(), return_inverse=True)
    first = np.searchsorted(code, np.arange(words + 1) * words).astype(np.int32)
    return Pairs(first, (code % max(words, 1)).astype(np.int32), which.astype(np.min_scalar_type(len(values))), values, least == 1), \
        pairs.where(~sent).select("u", "w", "x")


def _rare_words(sent) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        number = sent.value
        for batch in portions(batches, "text"):
            word, names, size = hpylm.numbered(batch.column("text"))
            key = _keys(names.to_pylist(), number)
            rare = np.flatnonzero(key[word] < 0)
            text = np.searchsorted(np.cumsum(size), rare, side="right")
            each = np.unique(text * len(names) + word[rare])
            yield pa.RecordBatch.from_pydict({"at": batch.column("at").take(pa.array(each // len(names))), "key": key[each % len(names)]})

    return run


_OWN = [("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())]
_OWN_SQL = "STRUCT<n_tokens: BIGINT, n_known: BIGINT, base: DOUBLE, score: DOUBLE>"
_PLACES_SQL = ("part INT, doc_id ARRAY<BIGINT>, text_hash ARRAY<BIGINT>, held_out ARRAY<BOOLEAN>, "
               f"own ARRAY<{_OWN_SQL}>, text BINARY, code BINARY, rest BINARY")
_SUMS_SQL = f"doc_id BIGINT, text_hash BIGINT, held_out BOOLEAN, own {_OWN_SQL}, more DOUBLE"


def _own_seating(word: np.ndarray, text: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """a and b of ``hpylm._own_seating`` for the places of many texts."""
    dish = text * (int(word.max()) + 1) + word
    order = np.argsort(dish, kind="stable")
    first = np.append(True, np.diff(dish[order]) != 0)
    earlier = np.empty(len(word), np.int64)
    earlier[order] = np.arange(len(word)) - np.flatnonzero(first)[np.cumsum(first) - 1]
    start = np.repeat(np.cumsum(size) - size, size)
    opened = np.append(0, np.cumsum(earlier == 0))
    customers = hpylm.TEXT_STRENGTH + np.arange(len(word)) - start
    a = np.where(earlier > 0, earlier - hpylm.TEXT_DISCOUNT, 0) / customers
    return a, (hpylm.TEXT_STRENGTH + hpylm.TEXT_DISCOUNT * (opened[:-1] - opened[start])) / customers


def _places(number_sent, frequent_sent, pairs_sent, discount: float, of_base: float, parts: int) -> Callable[[Batches], Batches]:
    """Of some texts a row with their sums as if no pair was stored but those known here, and a row for each part with
    its places whose pair may be stored: the text's place in the row, the pair's code (ascending) and ``rest``.

    With x of its pair, a place adds ln(x + exp(rest)) to the text's score and a sum that is known here.
    """

    def run(batches: Batches) -> Batches:
        number, frequent, pairs = number_sent.value, frequent_sent.value, pairs_sent.value
        samples = frequent.chance.shape[1]
        for batch in portions(batches, "text", SCORED):
            word, names, size = hpylm.numbered(batch.column("text"))
            names = names.to_pylist()
            at = np.fromiter(map(number.get, names, repeat(-1)), np.int64, len(names))
            rare = Figures.unpacked(batch.column("rare").flatten(), samples, discount, of_base)
            figures = frequent.rows(np.maximum(at, 0)) if len(number) else rare.rows(np.zeros(len(at), np.int64))
            other = np.flatnonzero(at < 0)
            if len(other):
                wanted = np.fromiter((_digest(names[j]) for j in other), np.int64, len(other))
                order = np.argsort(rare.key)
                figures.with_rows(other, rare.rows(order[np.searchsorted(rare.key, wanted, sorter=order)]))
            before, text = np.roll(word, 1), np.repeat(np.arange(len(size)), size)  # before a first token: the end mark
            a, b = _own_seating(word, text, size)
            all_customers = STRENGTH + figures.train[before]
            rest = np.logaddexp.reduce([figures.pull[before, i] + figures.chance[word, i] for i in range(samples)], axis=0)
            again = a > 0
            rest[again] = np.logaddexp(rest[again], np.log(a[again] * all_customers[again] / b[again]))
            held = np.repeat(batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool), size)
            shared = np.exp(rest)
            alone = np.where(held, rest, np.log(1 - discount + shared))
            known, x, stored_too = pairs.met(figures.key[before], figures.key[word])
            alone[known] = np.log(x + shared[known])
            per_text = lambda values: np.add.reduceat(values, np.cumsum(size) - size)
            own = [size, per_text((figures.train[word] > 0).astype(np.int64)), per_text(figures.base[word]),
                   per_text(np.log(b / all_customers) + alone) / LN10]
            met = np.flatnonzero(stored_too & (figures.seen[before] > 1) & (figures.seen[word] > 1))
            code = _codes(figures.key[before[met]], figures.key[word[met]], len(number))
            order = np.argsort(code)
            code, rest, text = code[order], rest[met[order]], text[met[order]]
            rest = (rest.view(np.int64) & ~0xFFFF).view(np.float64)  # eleven digits
            rows, sizes, packed = [np.arange(len(size))], [len(size)], [(int(text.sum()) % parts, b"", b"", b"")]
            for part, at in _blocks(_parts(code, parts)) if len(code) else ():
                mine, place = np.unique(text[at], return_inverse=True)
                rows.append(mine)
                sizes.append(len(mine))
                packed.append((part, _packed(place.astype(np.uint32)), _packed(_steps(code[at])), _packed(rest[at])))
            first = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
            index = pa.array(np.concatenate(rows))
            totals = pa.StructArray.from_arrays([pa.array(v, kind) for v, (_, kind) in zip(own, _OWN)], fields=[pa.field(*f) for f in _OWN])
            part, *columns = zip(*packed)
            yield pa.RecordBatch.from_arrays([
                pa.array(part, pa.int32()),
                *(pa.ListArray.from_arrays(first, batch.column(c).take(index)) for c in ("doc_id", "text_hash", "held_out")),
                pa.ListArray.from_arrays(pa.array([0] + [len(size)] * len(sizes), pa.int32()), totals),
                *(pa.array(c, pa.binary()) for c in columns)], ["part", "doc_id", "text_hash", "held_out", "own", "text", "code", "rest"])

    return run


def _stored_blocks(words: int, parts: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            u, w, x = _columns(batch, "u", "w", "x")
            code = _codes(u, w, words)
            order = np.argsort(code)
            code, x = code[order], x[order]
            if len(code):
                part, *columns = zip(*((p, _packed(_steps(code[at])), _packed(x[at])) for p, at in _blocks(_parts(code, parts))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int32()), *(pa.array(c, pa.binary()) for c in columns)], ["part", "code", "x"])

    return run


def _met(discount: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The texts' sums as they come, and what the places of a part add to them."""

    def run(places: pa.Table, pairs: pa.Table) -> pa.Table:
        code = np.concatenate([np.cumsum(_unpacked(c, np.int64)) for c in pairs["code"].to_pylist()] or [np.empty(0, np.int64)])
        x = np.concatenate([_unpacked(c, np.float64) for c in pairs["x"].to_pylist()] or [np.empty(0)])
        order = np.argsort(code)
        code, x = code[order], x[order]
        out = {f.name: [] for f in places.schema if f.name in ("doc_id", "text_hash", "held_out", "own")}
        mores = []
        for row in places.combine_chunks().to_batches():
            lists = {n: row.column(n) for n in out}
            for i in range(row.num_rows):
                doc_id, text_hash, held_out, own = (lists[n][i].values for n in ("doc_id", "text_hash", "held_out", "own"))
                more, place = np.zeros(len(doc_id)), _unpacked(row.column("text")[i].as_py(), np.uint32)
                at, known = hpylm._find(code, np.cumsum(_unpacked(row.column("code")[i].as_py(), np.int64)))
                if known.any():
                    place = place[known]
                    rest = _unpacked(row.column("rest")[i].as_py(), np.float64)[known]
                    held = held_out.to_numpy(zero_copy_only=False).astype(bool)[place]
                    met = np.log10(x[at[known]] + np.exp(rest))
                    met -= np.where(held, rest / LN10, np.log10(1 - discount + np.exp(rest)))
                    more = np.bincount(place, weights=met, minlength=len(more))
                if not len(own):
                    own = pa.nulls(len(doc_id), own.type)
                    changed = pa.array(np.flatnonzero(more))
                    doc_id, text_hash, held_out, own = (c.take(changed) for c in (doc_id, text_hash, held_out, own))
                    more = more[more != 0]
                for name, column in zip(("doc_id", "text_hash", "held_out", "own"), (doc_id, text_hash, held_out, own)):
                    out[name].append(column)
                mores.append(more)
        kinds = {n: places.schema.field(n).type.value_type for n in out}
        return pa.table({**{n: pa.chunked_array(c, kinds[n]) for n, c in out.items()}, "more": np.concatenate(mores or [np.empty(0)])})

    return run


@contextmanager
def _settings(spark: SparkSession, **values: str) -> Iterator[None]:
    names = {"shuffles_removed": "spark.sql.classic.shuffleDependency.fileCleanup.enabled",
             "rows_sent": "spark.sql.execution.arrow.maxRecordsPerBatch"}
    before = {names[k]: spark.conf.get(names[k], None) for k in values}
    for k, value in values.items():
        spark.conf.set(names[k], value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def scored(docs: DataFrame, frequent: int = FREQUENT, most_pairs: int = PAIRS) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    context = docs.sparkSession.sparkContext
    texts = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), text_of().alias("text"),
        (remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"))
    # Every job stores its result, so what it shuffled can go when it ends.
    few_rows = partial(_settings, docs.sparkSession, rows_sent="2000")  # texts are wide
    with _settings(docs.sparkSession, shuffles_removed="true"):
        with few_rows():
            words = stored(hpylm.vocabulary(texts), "vocabulary")
        least = hpylm._threshold(words, frequent)
        listed = words.where(F.col("seen") >= least).select("word").toArrow()["word"].to_pylist()  # at most ``frequent`` words
        number = context.broadcast({w: i for i, w in enumerate(sorted(listed))})
        words = stored(words.mapInArrow(_keyed(number), "word BINARY, train BIGINT, seen BIGINT, key BIGINT"), "keyed-words")
        parts = words.agg(F.coalesce(F.sum("seen"), F.lit(0))).first()[0] // IN_PART + 8
        with few_rows():
            pairs = stored(pair_counts(texts, number, len(listed), parts), "pairs")
        fitted = fit(words, pairs)
        figures, samples = stored(word_figures(words, fitted), "word-figures"), len(fitted.corpus)
        sent = context.broadcast(Figures.of(figures.where("key >= 0").toArrow().sort_by("key"), samples))
        frequent_pairs, other_pairs = sent_pairs(fitted.pairs, len(listed), most_pairs)
        pairs_sent = context.broadcast(frequent_pairs)
        del frequent_pairs
        blocks = other_pairs.mapInArrow(_stored_blocks(len(listed), parts), "part INT, code BINARY, x BINARY")
        blocks = stored(blocks, "pair-blocks").groupBy("part")
        rare_figures = figures.where("key < 0").select("key", "train", "seen", "tables", "chance") \
            .mapInArrow(Figures.packed(samples), "key BIGINT, figures BINARY")
        sums = []
        for turn in range(TURNS):
            some = texts.withColumn("at", F.xxhash64("doc_id", "text_hash")).where(F.pmod("at", F.lit(TURNS)) == turn)
            rare = some.select("text", "at").mapInArrow(_rare_words(number), "at BIGINT, key BIGINT") \
                .join(rare_figures, "key").groupBy("at").agg(F.collect_set("figures").alias("rare"))
            places = some.join(rare, "at", "left").select("doc_id", "text_hash", "held_out", "text", "rare") \
                .mapInArrow(_places(number, sent, pairs_sent, fitted.discount, fitted.of_base, parts), _PLACES_SQL)
            part = places.groupBy("part").cogroup(blocks).applyInArrow(_met(fitted.discount), _SUMS_SQL)
            part = part.groupBy("doc_id", "text_hash", "held_out").agg(
                F.count("own").alias("copies"), F.sum("own.n_tokens").alias("n_tokens"), F.sum("own.n_known").alias("n_known"),
                F.sum("own.base").alias("base"), F.sum(F.coalesce("own.score", F.lit(0.0)) + F.col("more")).alias("score"))
            with few_rows():
                sums.append(stored(part, "sums"))
    for broadcast in (number, sent, pairs_sent, *fitted.sent):
        broadcast.destroy()  # or idle workers keep them
    return hpylm.per_row(reduce(DataFrame.unionByName, sums), fitted.total)
