"""Mixing sources to target weights by drawing fixed-length blocks.

The words of a source, its documents in a fixed pseudorandom order, are cut
into blocks of ``BLOCK`` words. A source gets as many slots of the mix as its
target needs. Output shards of ``SHARD`` slots draw how many slots each source
has in them (a multinomial draw with a seed of its own); where the draws of all
shards together give a source more slots than it is due, its last ones go to
the sources that are short, in order, so that the totals are exact. Slot k of a
source takes block ``permutation(k mod blocks)``, with another permutation for
each round through the source, and slots and blocks meet in a join on the
index. No block is taken more than twice, as targets stop at twice the size.

Everything random is a hash of a seed and of an index: reruns, retried tasks
and other partitionings give the same mix. Slots and pieces come out of few
rows, which misleads size estimates; their joins are told to sort and merge.

Defined results: a null text has no words; a document without words is listed
with ``taken = 0``. A null source is a source of its own, last in order. Equal
rows are different documents of the mix. Documents of any length are cut into
blocks. An empty table, or one without words, gives an empty mix. Extra columns
are ignored or, in ``mixed``, passed on.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType

from overflight.llm.common import broadcast_if_small, in_files, space_words, stored, text_of

WEIGHTS = (5, 2, 1)  # by source, repeating
TOTAL_PERCENT = 150
MOST = 2  # times its size that a source may be taken
BLOCK = 128
SHARD = 65_536
GROUPS = 4096  # parts of a source whose offsets are summed apart
SEED = 17
ROUNDS = 6  # of the permutation
MANY_SOURCES = 100_000


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_source`` (sorts by code point, null last), ``_size``, ``_order`` and a row identity ``_id1, _id2``."""
    known = ("doc_id", "source", "text")
    return docs.select(
        "*",
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(">")).alias("_source"),
        F.size(space_words(text_of())).cast("long").alias("_size"),
        F.xxhash64(F.lit(SEED), *known).alias("_id1"),
        F.xxhash64(*reversed(known), F.lit(SEED)).alias("_id2"),
    )


def targets(sizes: DataFrame, percent: int = TOTAL_PERCENT, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``_source, source_size, blocks, slots, target`` by source.

    The share of a source that is not held at its limit is its weight times a
    common level. In order of limit over weight, a source is held if its limit
    lies below the level that it and the sources after it would have. There is
    one row per source here, hence windows over all of them.
    """
    everything = Window.partitionBy(F.lit(0))
    by_limit = everything.orderBy("ratio", "_source")
    each = sizes.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    turn = F.pmod(F.row_number().over(everything.orderBy("_source")) - 1, F.lit(len(weights)))
    each = each.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), turn))
    each = each.withColumn("limit", (F.col("source_size") * MOST).cast("double"))
    each = each.withColumn("ratio", F.col("limit") / F.col("weight"))
    total = F.sum("source_size").over(everything) * F.lit(percent) / F.lit(100.0)
    held = F.sum("limit").over(by_limit.rowsBetween(Window.unboundedPreceding, -1))
    left = F.sum("weight").over(by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    each = each.withColumn("level", (total - F.coalesce(held, F.lit(0.0))) / left)
    first = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "_source", "level"))).over(everything)
    each = each.withColumn("target", F.least("limit", F.coalesce(first["level"] * F.col("weight"), F.col("limit"))))
    blocks = F.ceil(F.col("source_size") / BLOCK)
    slots = F.when(F.col("source_size") > 0, F.round(F.col("target") * blocks / F.col("source_size"))).otherwise(0)
    return each.select("_source", "source_size", blocks.cast("long").alias("blocks"), slots.cast("long").alias("slots"), "target")


def _offsets(sizes: DataFrame) -> DataFrame:
    """Add ``_offset``, the words of the source before the document.

    A source is summed in ``GROUPS`` parts, so that no task holds a whole source.
    """
    rows = sizes.withColumn("_part", F.pmod("_id1", F.lit(GROUPS)))
    until = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("_source", "_part").agg(F.sum("_size").alias("_words"))
    parts = parts.select("_source", "_part", F.sum("_words").over(
        until(Window.partitionBy("_source").orderBy("_part"))).alias("_before"))
    inner = F.sum("_size").over(until(Window.partitionBy("_source", "_part").orderBy("_id1", "_id2")))
    zero = F.lit(0).cast("long")
    return rows.withColumn("_inner", inner).join(parts, ["_source", "_part"]).withColumn(
        "_offset", F.coalesce("_before", zero) + F.coalesce("_inner", zero)).drop("_before", "_inner", "_part")


@F.pandas_udf(LongType())
def _permuted(index: pd.Series, count: pd.Series, key: pd.Series) -> pd.Series:
    """A keyed permutation of 0..count-1: a Feistel network on the next power of four, repeated until inside."""
    x, n, key = (c.to_numpy().astype(np.uint64) for c in (index, count, key))
    half = ((np.ceil(np.log2(np.maximum(n, 2).astype(np.float64) + 1)).astype(np.uint64) + np.uint64(1)) // np.uint64(2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    left = np.ones(len(x), dtype=bool)
    while left.any():
        a, b = x[left] >> half[left], x[left] & mask[left]
        for turn in range(ROUNDS):
            f = (b + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) ^ key[left]
            f = (f ^ (f >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            f = (f ^ (f >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            a, b = b, a ^ ((f ^ (f >> np.uint64(31))) & mask[left])
        x[left] = (a << half[left]) | b
        left = x >= n
    return pd.Series(x.astype(np.int64))


def slots(sources: DataFrame, shard: int = SHARD) -> DataFrame:
    """``shard, slot, _source, round, block``: what each slot of the mix takes."""
    everything = Window.partitionBy(F.lit(0))  # over the sources
    due = sources.where("slots > 0").select("_source", "slots", "blocks")
    due = due.select(
        "*", F.sum("slots").over(everything.orderBy("_source")).alias("top"), F.sum("slots").over(everything).alias("total"))
    # One row that lists the sources with their upper ends on the unit interval.
    ends = due.groupBy("total").agg(F.sort_array(F.collect_list(
        F.struct((F.col("top") / F.col("total")).alias("end"), "_source"))).alias("ends"))
    last = F.least(F.lit(shard).cast("long"), F.col("total") - F.col("shard") * shard) - 1
    shards = ends.select("*", F.explode(F.expr(f"sequence(0L, CAST(ceil(total / {shard}) AS BIGINT) - 1)")).alias("shard"))
    # A few rows become all slots: spread them first, whatever AQE thinks of their size.
    tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    thrown = shards.repartition(tasks, "shard").select(
        "shard", "ends", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("slot"))
    unit = F.pmod(F.xxhash64(F.lit(SEED), "shard", "slot"), F.lit(1 << 53)) / F.lit(float(1 << 53))
    thrown = thrown.withColumn("unit", unit).select(
        "shard", "slot", F.filter("ends", lambda e: e["end"] > F.col("unit"))[0]["_source"].alias("_source"))

    slots_due = due.agg(F.max("total")).first()[0] or 0
    thrown = stored(thrown, "mix-slots", slots_due)
    counts = stored(thrown.groupBy("shard", "_source").agg(F.count("*").alias("n")), "mix-counts", slots_due)
    before = F.sum("n").over(Window.partitionBy("_source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    numbered = thrown.withColumn(
        "row", F.row_number().over(Window.partitionBy("shard", "_source").orderBy("slot")) - 1,
    ).hint("merge").join(counts.withColumn("before", F.coalesce(before, F.lit(0).cast("long"))).drop("n"), ["shard", "_source"])
    numbered = numbered.select("shard", "slot", "_source", (F.col("before") + F.col("row")).alias("k"))

    # Sources with too many draws free their last slots; sources with too few take them, both in order.
    drawn = due.join(counts.groupBy("_source").agg(F.sum("n").alias("drawn")), "_source", "left")
    drawn = drawn.withColumn("drawn", F.coalesce("drawn", F.lit(0).cast("long")))
    free, short = F.greatest(F.col("drawn") - F.col("slots"), F.lit(0)), F.greatest(F.col("slots") - F.col("drawn"), F.lit(0))
    in_order = everything.orderBy("_source")
    balance = stored(drawn.select(
        "_source", "slots", "blocks", "drawn", short.alias("short"),
        (F.sum(free).over(in_order) - free).alias("free_from"), (F.sum(short).over(in_order) - short).alias("short_from"),
    ), "mix-balance", MANY_SOURCES)
    few = broadcast_if_small(balance.select("_source", "slots", "free_from"), MANY_SOURCES)
    numbered = numbered.join(few, "_source")
    stay = numbered.where("k < slots").select("shard", "slot", "_source", "k")
    freed = numbered.where("k >= slots").select("shard", "slot", (F.col("free_from") + F.col("k") - F.col("slots")).alias("free"))
    taker = broadcast_if_small(balance.where("short > 0").select("_source", "drawn", "short_from", "short"), MANY_SOURCES)
    moved = freed.join(
        taker, (F.col("free") >= F.col("short_from")) & (F.col("free") < F.col("short_from") + F.col("short"))
    ).select("shard", "slot", "_source", (F.col("drawn") + F.col("free") - F.col("short_from")).alias("k"))

    sizes = broadcast_if_small(balance.select("_source", "blocks"), MANY_SOURCES)
    turn = F.floor(F.col("k") / F.col("blocks"))
    return stay.unionByName(moved).join(sizes, "_source").select(
        "shard", "slot", "_source", turn.alias("round"),
        _permuted(F.col("k") % F.col("blocks"), F.col("blocks"), F.xxhash64(F.lit(SEED), "_source", turn)).alias("block"))


def pieces(rows: DataFrame) -> DataFrame:
    """The part of every document in each block it reaches: ``first`` (word of the document) and ``words``."""
    start, end = F.col("block") * BLOCK, (F.col("block") + 1) * BLOCK
    first = F.greatest(start - F.col("_offset"), F.lit(0).cast("long"))
    span = F.sequence(F.floor(F.col("_offset") / BLOCK), F.floor((F.col("_offset") + F.col("_size") - 1) / BLOCK))
    return rows.where("_size > 0").withColumn("block", F.explode(span)).withColumn("first", first).withColumn(
        "words", F.least(end - F.col("_offset"), F.col("_size")) - first)


def _plan(docs: DataFrame, percent: int, weights: tuple[int, ...]) -> tuple[DataFrame, DataFrame]:
    """The documents' sizes and offsets, and the sources, both stored."""
    rows = sized(docs.select("doc_id", "source", "text")).select("doc_id", "_source", "_size", "_id1", "_id2")
    n = docs.count()
    rows = stored(in_files(rows, n), "mix-sizes")
    return stored(_offsets(rows), "mix-offsets", n), stored(targets(rows, percent, weights), "mix-targets", MANY_SOURCES)


def mix(docs: DataFrame, percent: int = TOTAL_PERCENT, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per document: size, size and target of its source, words the mix takes of it."""
    rows, sources = _plan(docs, percent, weights)
    times = slots(sources).groupBy("_source", "block").agg(F.count("*").alias("times"))
    taken = pieces(rows).hint("merge").join(times, ["_source", "block"]).groupBy("_source", "_offset", "_id1", "_id2").agg(
        F.sum(F.col("words") * F.col("times")).alias("taken"))
    few = broadcast_if_small(sources.select("_source", "source_size", "target"), MANY_SOURCES)
    # A document with words has its offset for itself.
    return rows.join(few, "_source").hint("merge").join(taken, ["_source", "_offset", "_id1", "_id2"], "left").select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target",
        F.when(F.col("_size") > 0, F.coalesce("taken", F.lit(0).cast("long"))).otherwise(0).cast("long").alias("taken"))


def mixed(docs: DataFrame, percent: int = TOTAL_PERCENT, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The mix as documents: for each round that takes words of a document, a row with those words.

    A document that a round takes whole keeps its text; otherwise the words of
    its taken blocks, in order, are joined by spaces. ``n_chars``, if there is
    one, follows the text.
    """
    rows, sources = _plan(docs, percent, weights)
    found = pieces(rows).hint("merge").join(slots(sources), ["_source", "block"]).groupBy(
        "_source", "_offset", "_id1", "_id2", "_size", "round"
    ).agg(F.sum("words").alias("_taken"), F.sort_array(F.collect_list(F.struct("first", "words"))).alias("_parts"))
    found = found.select("_id1", "_id2", "_size", "_taken", "_parts")
    own = {c: f"_own{n}" for n, c in enumerate(docs.columns) if c not in ("text", "n_chars")}  # in a struct no name clashes
    plain = docs.select("doc_id", "source", "text", F.struct(*[F.col(c).alias(o) for c, o in own.items()]).alias("_row"))
    texts = sized(plain).select("_id1", "_id2", "text", "_row").dropDuplicates(["_id1", "_id2"])
    words = F.flatten(F.transform("_parts", lambda p: F.slice(
        "_words", (p["first"] + 1).cast("int"), p["words"].cast("int"))))
    text = F.when(F.col("_taken") == F.col("_size"), F.col("text")).otherwise(F.array_join(words, " "))
    out = found.hint("merge").join(texts, ["_id1", "_id2"]).withColumn("_words", space_words(text_of())).withColumn("text", text)
    fresh = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        fresh["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[(fresh[c] if c in fresh else F.col(f"_row.{own[c]}")).alias(c) for c in docs.columns])
