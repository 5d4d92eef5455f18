"""Substring dedup by suffix trees over groups of suffixes with a common prefix.

Every window of ``length`` consecutive words whose words also start at another
place, of the same or any other document, is removed. The suffixes that start
at the places of all documents are split by prefixes, each group gets a suffix
tree of its own, and the internal nodes ``length`` words deep or deeper name
the repeats: all suffixes below such a node start with the same window.

* Variable-length prefixes: a suffix's prefix ends with its anchor, the
  ``GRAM``-word run with the smallest hash among those in its first ``length``
  words, so it has ``GRAM`` to ``length`` words. Equal windows have equal
  prefixes. All prefixes that end in one anchor make a group; neighbouring
  suffixes share anchors, so a group takes them as one piece of text instead of
  ``length`` words for each.
* Pruning: a prefix that occurs once has no internal node below it. Anchors are
  counted first (combined on the map side), and only suffixes with a repeated
  anchor take part.
* Memory-sized groups: anchors are packed into bins of about ``BIN_WORDS``
  words. A prefix with more than ``MANY`` occurrences is lengthened to the whole
  window: its node is then named by the 128-bit digest of the window, and a
  count tells whether it has one leaf or more, so no task ever sees all the
  occurrences of a frequent passage.
* Documents with the same text are one node with a number of copies. Windows
  that repeat inside a text are found there; only the first takes part.

A tree is built level by level: suffixes are ranked by their first word, then
by 2, 4, 8 ... words from the ranks of halves, which numbers the ancestors of
every leaf at these depths. Words are compared as they are, not by hash; hashes
choose anchors, and 64-bit ones tell repeats inside one text, 128-bit ones
equal texts and the windows of frequent prefixes.

Defined results: null and empty texts and texts without words have no words and
lose none. Texts shorter than a window lose nothing, even if they are equal.
Documents are rows: repeated rows, with the same id or not, are copies of each
other. A null id is an id. Texts may have any length (a task holds one text and
a few numbers for each of its words). An empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from overflight.llm.common import broadcast_if_small, portions, stored, text_of

LENGTH = 35
GRAM = 8
BIN_WORDS = 250_000
MANY = 2_000  # occurrences of an anchor
MANY_ANCHORS = 500_000

_ODD = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)]
_PLACE = np.uint64((1 << 28) - 1)


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of runs from those of their two parts."""
    mixed = ((a ^ (a >> np.uint64(29))) * _ODD[0] + b) * _ODD[1]
    return mixed ^ (mixed >> np.uint64(32))


def _doubled(parts: np.ndarray, size: int, join: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Something of all runs of ``size`` neighbours, from that of single ones: runs of 1, 2, 4 ..., then two that overlap."""
    width = 1
    while width * 2 <= size:
        parts = join(parts[:-width], parts[width:])
        width *= 2
    return join(parts[:len(parts) - (size - width)], parts[size - width:]) if width < size else parts


def _word_hashes(words: list[bytes]) -> np.ndarray:
    hashes = {w: xxhash.xxh3_64_intdigest(w) for w in set(words)}
    return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


def runs(words: list[bytes], length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first window and number of windows of every run with one anchor, and the windows repeated in this text.

    Of windows that repeat here the first alone belongs to a run.
    """
    if len(words) < length:
        return np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(3))
    each = _word_hashes(words)
    grams = _doubled(each, gram, _joined)
    # The smallest hash with its place; among equal ones the first.
    placed = (grams & ~_PLACE) | (np.arange(len(grams), dtype=np.uint64) & _PLACE)
    at = (_doubled(placed, length - gram + 1, np.minimum) & _PLACE).astype(np.int64)
    windows = np.arange(len(at))
    _, first, inverse, times = np.unique(_doubled(each, length, _joined), return_index=True, return_inverse=True, return_counts=True)
    taken = first[inverse] == windows
    cut = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (taken[1:] != taken[:-1]))))
    sizes = np.diff(np.append(cut, len(at)))
    use = taken[cut]
    return grams[at[cut[use]]], cut[use], sizes[use], np.flatnonzero(times[inverse] > 1)


def spans(places: np.ndarray) -> tuple[list[int], list[int]]:
    """Sorted places as starts and sizes of runs of neighbours."""
    if not len(places):
        return [], []
    cut = np.flatnonzero(np.concatenate(([True], np.diff(places) != 1)))
    return places[cut].tolist(), np.diff(np.append(cut, len(places))).tolist()


_SKETCH = "digest STRING, doc_id BIGINT, anchors ARRAY<BIGINT>, starts ARRAY<INT>, sizes ARRAY<INT>, own_starts ARRAY<INT>, own_sizes ARRAY<INT>"


def _sketched(length: int, gram: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "text"):
            out: dict[str, list] = {name: [] for name in ("anchors", "starts", "sizes", "own_starts", "own_sizes")}
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                anchors, starts, sizes, own = runs(text.split(), length, gram)
                own_starts, own_sizes = spans(own)
                for name, values in zip(out, (anchors.view(np.int64), starts, sizes, own_starts, own_sizes)):
                    out[name].append(values)
            yield pa.RecordBatch.from_pydict({
                "digest": batch.column("digest"), "doc_id": batch.column("doc_id").cast(pa.int64()),
                "anchors": pa.array(out["anchors"], pa.list_(pa.int64())),
                **{name: pa.array(out[name], pa.list_(pa.int32())) for name in ("starts", "sizes", "own_starts", "own_sizes")}})

    return run


def _pieces(length: int, bins: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts with the runs to cut out of them in; pieces of text for the bins out."""
    schema = pa.schema([("bin", pa.int32()), ("node", pa.int64()), ("start", pa.int32()), ("piece", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "text", 1 << 20):
            bins_, nodes, starts, cut = [], [], [], []
            for text, node, found in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("node").to_pylist(),
                                         batch.column("runs").to_pylist()):
                words = text.split()
                for r in found:
                    bins_.append(r["anchor"] % bins)
                    nodes.append(node)
                    starts.append(r["start"])
                    cut.append(b" ".join(words[r["start"]:r["start"] + r["size"] + length - 1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bins_, pa.int32()), pa.array(nodes, pa.int64()), pa.array(starts, pa.int32()), pa.array(cut, pa.binary())], schema=schema)

    return run


def _digested(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts with runs in; every window of the runs with its digest out, which is the prefix lengthened to the whole window."""
    schema = pa.schema([("window", pa.binary()), ("node", pa.int64()), ("start", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "text", 1 << 20):
            digests, nodes, starts = [], [], []
            for text, node, found in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("node").to_pylist(),
                                         batch.column("runs").to_pylist()):
                words = text.split()
                for start in (r["start"] + i for r in found for i in range(r["size"])):
                    digests.append(blake2b(b" ".join(words[start:start + length]), digest_size=16).digest())
                    nodes.append(node)
                    starts.append(start)
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), pa.array(nodes, pa.int64()), pa.array(starts, pa.int32())], schema=schema)

    return run


def tree_nodes(pieces: list[list[bytes]], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Piece and place of all suffixes of ``length`` words or more, and the number of each one's ancestor at that depth.

    The ranks of 1, 2, 4 ... words number the ancestors at these depths, in the order of the suffixes' first words.
    """
    numbers: dict[bytes, int] = {}
    sizes = np.array([len(p) for p in pieces])
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for p in pieces for w in p), np.int64, int(sizes.sum()))

    def ranked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        most = int(max(a.max(initial=0), b.max(initial=0))) + 1
        return np.unique(a * most + b, return_inverse=True)[1]

    ancestors = _doubled(ids, length, ranked)
    # Windows that would run over the end of their piece are no suffixes.
    piece = np.repeat(np.arange(len(pieces)), sizes)
    place = np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    whole = np.flatnonzero((place + length <= sizes[piece])[:len(ancestors)])
    return piece[whole], place[whole], ancestors[whole]


def _trees(length: int) -> Callable[[pa.Table], pa.Table]:
    """The pieces of a bin in; node, first window and number of windows of the repeats out."""

    def run(rows: pa.Table) -> pa.Table:
        piece, place, ancestor = tree_nodes([p.split(b" ") for p in rows.column("piece").to_pylist()], length)
        repeated = np.bincount(ancestor)[ancestor] > 1
        piece, place = piece[repeated], place[repeated]
        node, start = rows.column("node").to_numpy()[piece], rows.column("start").to_numpy()[piece] + place
        cut = np.flatnonzero(np.concatenate(([True], (np.diff(piece) != 0) | (np.diff(place) != 1)))) if len(piece) else np.empty(0, np.int64)
        return pa.table({"node": pa.array(node[cut], pa.int64()), "start": pa.array(start[cut], pa.int32()),
                         "size": pa.array(np.diff(np.append(cut, len(piece))), pa.int32())})

    return run


_RANGE = "kind INT, start INT, size INT"
REPEATED, ASKED, ALONE = 1, 0, -1


def _removed(n: int, found: list[dict], length: int) -> np.ndarray:
    """Which of n words lie in a repeated window."""
    windows = np.zeros(max(0, n - length + 1), dtype=bool)
    for kind, value in ((ASKED, True), (ALONE, False), (REPEATED, True)):
        for r in found:
            if r["kind"] == kind:
                windows[r["start"]:r["start"] + r["size"]] = value
    steps = np.zeros(n + 1, dtype=np.int64)
    at = np.flatnonzero(windows)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + length, -1)
    return np.cumsum(steps[:n]) > 0


def _kept(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string()),
                        ("removed", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "text"):
            n_words, n_removed, kept, removed = [], [], [], []
            columns = (batch.column("text").cast(pa.binary()), batch.column("copies"), batch.column("ranges"))
            for text, copies, found in zip(*(c.to_pylist() for c in columns)):
                words = text.split()
                if copies != 1:  # another row has this text
                    gone = np.full(len(words), len(words) >= length)
                else:
                    gone = _removed(len(words), found or [], length)
                n_words.append(len(words))
                n_removed.append(int(gone.sum()))
                kept.append(b" ".join(compress(words, (~gone).tolist())))
                removed.append([{"first": s, "last": s + n - 1} for s, n in zip(*spans(np.flatnonzero(gone)))])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.int64()), batch.column("digest"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string()), pa.array(removed, schema.field("removed").type)], schema=schema)

    return run


def _key() -> Column:
    """Never null, so that joins add no condition to the texts and their one shuffle serves all of them."""
    return F.xxhash64("doc_id", "digest").alias("key")


def cleaned(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """One row per document: doc_id, digest (of the text), n_words, n_removed, kept_text, removed (word spans)."""
    texts = docs.select("doc_id", text_of().alias("text"), F.md5(text_of()).alias("digest"))
    first = F.min(F.struct("doc_id", "anchors", "starts", "sizes", "own_starts", "own_sizes")).alias("first")
    sketches = texts.mapInArrow(_sketched(length, gram), _SKETCH).groupBy("digest").agg(F.count("*").alias("copies"), first)
    classes = stored(sketches.select("digest", "copies", "first.*").withColumn("node", F.monotonically_increasing_id()), "classes")

    known = classes.count()
    posted = classes.select("node", F.explode(F.arrays_zip("anchors", "starts", "sizes")).alias("r")).select(
        "node", F.col("r.anchors").alias("anchor"), F.col("r.starts").alias("start"), F.col("r.sizes").alias("size"))
    counts = posted.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    frequent = stored(counts.where(F.col("n") > MANY).select("anchor"), "frequent-anchors", known)
    rare = counts.where(F.col("n") <= MANY).select("anchor", F.lit(False).alias("frequent"))
    often = broadcast_if_small(frequent.withColumn("frequent", F.lit(True)), MANY_ANCHORS)
    # Frequent anchors leave before the shuffle that would bring all their runs to one task.
    found = posted.join(often, "anchor", "left_anti").join(rare, "anchor").unionByName(posted.join(often, "anchor"))
    # One row per text, with the runs that meet others: those of rare and of frequent anchors.
    run = F.struct("anchor", "start", "size")
    meeting = stored(found.groupBy("node").agg(
        F.collect_list(F.when(~F.col("frequent"), run)).alias("rare"), F.collect_list(F.when(F.col("frequent"), run)).alias("frequent")),
        "runs", known)

    # One shuffle of the texts, by row; every join below reads it.
    by_row = texts.withColumn("key", _key()).repartition("key")
    nodes = classes.select("node", "copies", "doc_id", "digest", _key(), "own_starts", "own_sizes")

    def with_runs(which: str) -> DataFrame:
        listed = meeting.where(F.size(which) > 0).select("node", F.col(which).alias("runs"))
        wanted = listed.join(nodes.select("node", "doc_id", "digest", "key"), "node")
        return by_row.alias("t").join(wanted.alias("w"), "key").where(
            "t.doc_id <=> w.doc_id AND t.digest = w.digest").select("t.text", "w.node", "w.runs")

    size_of = lambda runs: F.aggregate(runs, F.lit(0).cast("long"), lambda total, r: total + r["size"] + F.lit(length - 1))
    words, some = meeting.agg(F.sum(size_of("rare")), F.max(F.size("frequent"))).first()
    bins = (words or 0) // BIN_WORDS + 1
    pieces = with_runs("rare").mapInArrow(_pieces(length, bins), "bin INT, node BIGINT, start INT, piece BINARY")
    found = pieces.groupBy("bin").applyInArrow(_trees(length), "node BIGINT, start INT, size INT")
    ranges = found.select("node", F.struct(F.lit(REPEATED).alias("kind"), "start", "size").alias("range"))
    own = nodes.select("node", F.explode(F.arrays_zip("own_starts", "own_sizes")).alias("r"))
    ranges = ranges.unionByName(own.select("node", F.struct(
        F.lit(REPEATED).alias("kind"), F.col("r.own_starts").alias("start"), F.col("r.own_sizes").alias("size")).alias("range")))
    if some:
        leaves = with_runs("frequent").mapInArrow(_digested(length), "window BINARY, node BIGINT, start INT")
        alone = leaves.groupBy("window").agg(F.count("*").alias("n"), F.min(F.struct("node", "start")).alias("leaf")).where("n = 1")
        asked = meeting.select("node", F.explode("frequent").alias("r"))
        ranges = ranges.unionByName(asked.select("node", F.struct(
            F.lit(ASKED).alias("kind"), "r.start", "r.size").alias("range"))).unionByName(alone.select(
                "leaf.node", F.struct(F.lit(ALONE).alias("kind"), "leaf.start", F.lit(1).alias("size")).alias("range")))
    ranges = ranges.groupBy("node").agg(F.collect_list("range").alias("ranges"))
    marks = nodes.select("node", "copies", "doc_id", "digest", "key").join(ranges, "node", "left")
    rows = by_row.alias("t").join(marks.alias("m"), F.expr("t.key = m.key AND t.doc_id <=> m.doc_id AND t.digest = m.digest"), "left")
    return rows.select("t.doc_id", "t.digest", "t.text", "m.copies", "m.ranges").mapInArrow(
        _kept(length), "doc_id BIGINT, digest STRING, n_words BIGINT, n_removed BIGINT, kept_text STRING, removed ARRAY<STRUCT<first: INT, last: INT>>")


def digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    return cleaned(docs, length).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
