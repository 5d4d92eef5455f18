"""Benchmark decontamination with spaced seeds.

A seed hashes some of the words under a fixed mask and ignores the others, so a
changed word at an ignored place does not hide the match. The seeds of every
training position are joined with those of the benchmark; each hit fixes an
alignment of the two texts, and the words around it are compared: an overlap is
a window of ``WINDOW`` words (the whole item, if it is shorter) of which at
least ``identity`` are the same at the same places. The masks are chosen so that
every such window holds a hit, whichever of its words were changed (a test goes
through all patterns), and of the windows that contain a hit the best one
counts, so what is found does not depend on the masks.

Items shorter than ``SPAN`` words are hashed whole, at each length that occurs,
and found as consecutive runs, without tolerance. Below ``LEAST_RUN`` words a
run says nothing (an item of one common word would mark every text), so such an
item is found only where it is the whole text. Items without a word match
nothing.

The benchmark's seeds are broadcast when a count shows at most ``MANY_SEEDS``
of them. Beyond that, positions and seeds meet in a shuffled join and the words
of the texts that were hit are joined in afterwards, with the same result.

Defined results: null and empty texts, or an empty table, match nothing. Equal
training rows count as one text (the result names documents, not rows); a
document id with several different texts is reported with each item once. Null
ids are kept. Items with the same id and different texts are searched one by
one and reported under that id. Extra columns are ignored or, in ``cleaned``,
passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from overflight.llm.common import alnum_words, fits, row_key, stored, text_of

# 1 is hashed, 0 ignored. Found by search: no other three masks of five words were shorter.
MASKS = ("111101", "10100111", "11011001")
SPAN = max(map(len, MASKS))
LEAST_RUN = 5
WINDOW = 16
IDENTITY = 0.8
MANY_SEEDS = 1_000_000


def _seeds(words: str, at: Column, short: list[int]) -> list[Column]:
    """The seeds that start at a position, those of the masks first; null where the text ends before."""
    n = F.size(words)
    word = lambda i: F.get(words, at + i)
    seed = lambda mark, used, span: F.when(at + span <= n, F.xxhash64(F.lit(mark), *map(word, used)))
    masked = [seed(number, [i for i, bit in enumerate(mask) if bit == "1"], len(mask)) for number, mask in enumerate(MASKS)]
    return masked + [
        F.when((n == size) | F.lit(size >= LEAST_RUN), seed(-size, range(size), size)) for size in short]


def _positions(texts: DataFrame, words: str, short: list[int], keep: list[str]) -> DataFrame:
    """``seed, span`` of every position. There are as many of them as words, so a position makes one array of plain numbers, and
    the outer explode keeps Spark from splitting each text a second time to see whether it has words."""
    spans = F.array(*[F.lit(len(mask)) for mask in MASKS], *map(F.lit, short))
    at = texts.select(*keep, words, F.posexplode_outer(words).alias("at", "word"))
    at = at.select(*keep, words, "at", F.posexplode(F.array(*_seeds(words, F.col("at"), short))).alias("_mark", "seed"))
    return at.where("seed IS NOT NULL").select(*keep, words, "at", "seed", F.get(spans, F.col("_mark")).alias("span"))


def _near(found: DataFrame) -> DataFrame:
    """In place of a text's words how many there are (``n_words``) and, from ``near_from`` on, those that a window around the hit
    can hold (``near``), so that a row of a hit is as small in a long text as in a short one."""
    start = F.greatest(F.lit(0), F.col("at") - WINDOW)
    return found.withColumns({"n_words": F.size("words"), "near_from": start, "near": F.slice("words", start + 1, F.lit(2 * WINDOW))}) \
        .drop("words")


def benchmark_seeds(items: DataFrame, short: list[int]) -> DataFrame:
    """``item, q, item_seed, span``; a short item has the one seed of its own length."""
    masked = _positions(items.where(F.size("item_words") >= SPAN), "item_words", [], ["item"])
    rows = masked
    for size in short:
        own = _positions(items.where(F.size("item_words") == size), "item_words", [size], ["item"])
        rows = rows.unionByName(own.where(F.col("span") == size).where(
            F.col("seed") == F.xxhash64(F.lit(-size), *[F.get("item_words", F.lit(i)) for i in range(size)])))
    return rows.select("item", F.col("at").alias("q"), F.col("seed").alias("item_seed"), "span")


def _confirmed(found: DataFrame, identity: float) -> DataFrame:
    """``window``: the words of the text, from ``first`` to ``last``, that lie in windows around a hit with enough
    equal words, and the share of the best one.

    Windows lie inside both texts. If the two share fewer aligned places than a
    window has, the missing ones count as different.
    """
    size = F.least(F.size("item_words"), F.lit(WINDOW))
    shift = F.col("at") - F.col("q")
    low = F.greatest(F.lit(0), -shift)
    high = F.least(F.size("item_words"), F.col("n_words") - shift)
    length = F.least(size, high - low)
    place = lambda start: F.greatest(low, F.least(start, high - length))
    placed = found.withColumn("_size", size).withColumn("_length", length).withColumn("_shift", shift) \
        .withColumn("_from", place(F.col("q") + F.col("span") - length)).withColumn("_to", place(F.col("q")))
    reach = F.col("_to") - F.col("_from") + F.col("_length")
    ours = F.slice("item_words", F.col("_from") + 1, reach)
    theirs = F.slice("near", F.col("_from") + F.col("_shift") - F.col("near_from") + 1, reach)
    placed = placed.withColumn("_equal", F.zip_with(ours, theirs, lambda a, b: F.coalesce((a == b).cast("int"), F.lit(0))))
    same = lambda start: F.aggregate(F.slice("_equal", start + 1, F.col("_length")), F.lit(0), lambda total, x: total + x)
    windows = F.transform(F.sequence(F.lit(0), F.col("_to") - F.col("_from")), lambda k: F.struct(
        (F.col("_from") + F.col("_shift") + k).alias("first"), (F.col("_from") + F.col("_shift") + k + F.col("_length") - 1).alias("last"),
        (same(k) / F.col("_size")).alias("share")))
    return placed.withColumn("window", F.explode(F.filter(windows, lambda w: w["share"] >= identity)))


def overlaps(docs: DataFrame, benchmark: DataFrame, identity: float = IDENTITY, many_seeds: int = MANY_SEEDS) -> DataFrame:
    """Rows ``doc_id, item_id, item_words, first_word, last_word, identity`` for documents that hold a benchmark passage."""
    items = benchmark.select(
        "item_id", F.xxhash64("item_id", "text").alias("item"), alnum_words(text_of()).alias("item_words")
    ).where(F.size("item_words") > 0)
    # At most SPAN - 1 numbers, whatever the benchmark.
    short = sorted(r[0] for r in items.where(F.size("item_words") < SPAN)
                   .select(F.size("item_words")).distinct().collect())
    seeds = stored(benchmark_seeds(items, short), "benchmark-seeds")
    texts = docs.select(*row_key(), alnum_words(text_of()).alias("words"))
    at = _positions(texts, "words", short, ["doc_id", "text_hash"])
    items = items.dropDuplicates(["item"])
    if fits(seeds, many_seeds):  # then the items' words are as few
        hits = at.drop("span").join(F.broadcast(seeds), F.col("seed") == F.col("item_seed"))
        found = _near(hits).join(F.broadcast(items), "item")
    else:
        key = ["doc_id", "text_hash"]
        met = at.select(*key, "at", "seed").join(seeds, F.col("seed") == F.col("item_seed")).distinct()
        one = texts.dropDuplicates(key).withColumnsRenamed({k: f"_{k}" for k in key})
        hits = met.join(one, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_hash") == F.col("_text_hash")))
        found = _near(hits).join(items, "item")
    return _confirmed(found, identity).groupBy("doc_id", "item_id").agg(
        F.max(F.size("item_words")).cast("long").alias("item_words"),
        F.min("window.first").cast("long").alias("first_word"),
        F.max("window.last").cast("long").alias("last_word"),
        F.max("window.share").alias("identity"),
    )


def cleaned(docs: DataFrame, benchmark: DataFrame, identity: float = IDENTITY) -> DataFrame:
    """The documents without a benchmark passage, with their columns."""
    found = overlaps(docs, benchmark, identity).select(F.col("doc_id").alias("_doc_id")).distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(found["_doc_id"]), "left_anti")
