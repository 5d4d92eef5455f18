"""Near duplicates by an inverted join on MinHash signature coordinates.

Every document gets a signature of ``COORDINATES`` MinHash values. A coordinate
with its value is a token; documents are posted under their tokens. Two
documents whose sets are similar enough share at least ``matches`` tokens
(all but a chance below 1e-8 at the threshold itself), which leaves only short
lists to look at:

* skip: a document that shares fewer than ``matches`` of its tokens with
  anything else is posted nowhere;
* prefix: the others are posted under the rarest of their shared tokens only,
  so many that two documents with enough matches must meet (tokens in one order
  for all, by frequency).

Documents with the same set are one node from the start. The documents of a
list are not paired with each other: each meets the list's hub, its member with
the most frequent tokens, which is where copies of one text agree. Links are
confirmed on the full sets. Only documents that this leaves outside the hub's
component are compared with the rest of the hub's group, block by block: the
collisions of the signatures are counted first, and pairs whose components have
met meanwhile are passed over. Links are therefore complete for components,
while a group of n copies costs about n comparisons.

Defined results: null, empty and wordless texts have the empty set and are
linked with nothing. A text shorter than a shingle has its whole sequence as
one. Rows with the same id are one document: linked, if any of their texts is.
A null id cannot name a component: such rows are linked with nothing and kept.
Ties go to the smallest id. Texts may have any length, an empty table gives an
empty result. Extra columns are ignored or, in ``deduplicated``, passed on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from overflight.llm.common import broadcast_if_small, in_files, portions, stored

COORDINATES = 96
DEVIATIONS = 6.3  # below the expected number of matches
BLOCK = 400  # documents compared with as many others in one piece
MANY_NODES = 500_000

_random = np.random.default_rng(20_240_101)
_FACTORS = _random.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) | np.uint64(1)
_TERMS = _random.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
_ORDER = _random.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def matches(percent: int) -> int:
    """Equal coordinates that a pair at the threshold has at least."""
    s = percent / 100
    return int(COORDINATES * s - DEVIATIONS * (COORDINATES * s * (1 - s)) ** 0.5)


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of lower-cased (A-Z) words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = {w: xxhash.xxh3_64_intdigest(w) for w in set(words)}
    each = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    mixed = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _ORDER[i % len(_ORDER)] + each[i:i + len(mixed)]
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(mixed ^ (mixed >> np.uint64(32)))


def signature(members: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over the set; sets of any size in bounded memory."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for first in range(0, len(members), 4096):
        part = members[first:first + 4096, None] * _FACTORS + _TERMS
        least = np.minimum(least, (part >> np.uint64(32)).min(axis=0))
    return least.astype(np.uint32).view(np.int32)


def _signed(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "text"):
            sets = [shingles(t, size) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id").cast(pa.int64()), "n_shingles": pa.array(map(len, sets), pa.int64()),
                "digest": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                "signature": pa.array([signature(s) if len(s) else None for s in sets], pa.list_(pa.int32()))})

    return run


def _sets(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "text"):
            sets = [shingles(t, size) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "node": batch.column("doc_id").cast(pa.int64()),
                "signature": pa.array([signature(s) for s in sets], pa.list_(pa.int32())),
                "members": pa.array([s.tobytes() for s in sets], pa.binary())})

    return run


def hub_groups(nodes: DataFrame, needed: int, most: int) -> DataFrame:
    """``hub, node``: every document that is posted in a list, with that list's hub.

    ``nodes`` has node and signature. A document's shared tokens number at most
    ``COORDINATES``; lists are only ever reduced to their hub. ``most`` is the
    number of nodes.
    """
    token = F.shiftleft(F.col("at").cast("long"), 32) + F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
    posted = nodes.select("node", F.posexplode("signature").alias("at", "value")).select("node", token.alias("token"))
    frequency = posted.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    shared = posted.join(frequency, "token").groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("df", "token"))).alias("tokens"), F.sum("df").alias("weight"))
    shared = shared.where(F.size("tokens") >= needed)
    prefix = F.slice("tokens", F.lit(1), F.size("tokens") - needed + 1)
    lists = stored(shared.select("node", "weight", F.explode(F.transform(prefix, lambda t: t["token"])).alias("token")), "lists", 8 * most)
    hubs = lists.groupBy("token").agg(F.max(F.struct("weight", (-F.col("node")).alias("order"))).alias("top"), F.count("*").alias("n"))
    hubs = hubs.where("n > 1").select("token", (-F.col("top.order")).alias("hub"))
    return lists.join(hubs, "token").select("hub", "node").distinct()


def jaccard(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sizes of intersection and union of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0, len(b)
    place = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[place] == a).sum())
    return both, len(a) + len(b) - both


def _linked(a: bytes, b: bytes, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both, union = jaccard(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64))
    return 100 * both >= percent * union


def _confirm(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("members"), batch.column("hub_members")
            same = [_linked(x.as_buffer(), y.as_buffer(), percent) for x, y in zip(a, b)]
            yield pa.RecordBatch.from_pydict({
                "hub": batch.column("hub"), "node": batch.column("node"), "linked": pa.array(same, pa.bool_())})

    return run


def _compare(percent: int, needed: int) -> Callable[[pa.Table], pa.Table]:
    """Links across components between the two sides of a block; one for each two components is enough."""

    def run(rows: pa.Table) -> pa.Table:
        node, component = rows.column("node").to_numpy(), rows.column("component").to_numpy()
        outside = rows.column("outside").to_numpy(zero_copy_only=False)
        signatures = np.array(rows.column("signature").to_pylist(), dtype=np.int32)
        members = [np.frombuffer(m.as_buffer(), np.uint64) for m in rows.column("members")]
        size = np.array([len(m) for m in members])
        root = {c: c for c in component.tolist()}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        links = []
        inside = np.flatnonzero(~outside)
        for i in np.flatnonzero(outside):
            others = inside[component[inside] != component[i]]
            collisions = (signatures[others] == signatures[i]).sum(axis=1)
            able = (collisions >= needed) & (100 * np.minimum(size[others], size[i]) >= percent * np.maximum(size[others], size[i]))
            for j in others[able][np.argsort(-collisions[able], kind="stable")]:
                a, b = find(int(component[i])), find(int(component[j]))
                if a != b:
                    both, union = jaccard(members[i], members[j])
                    if 100 * both >= percent * union:
                        root[max(a, b)] = min(a, b)
                        links.append((int(node[i]), int(node[j])))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return run


def components(links: DataFrame, most: int | None = None) -> DataFrame:
    """``node, component``: the smallest node reachable, for nodes with a link.

    Large-star and small-star steps on the links alone: every node passes its
    smallest neighbour on to the others, until all links point at the smallest
    node of their component. Each step is written to the shared folder.
    """
    def state(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    pairs = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    pairs = stored(pairs, "links", most)
    before = state(pairs)
    while True:
        # Every neighbour above a node is sent to the node's smallest neighbour.
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        # Then all lower neighbours of a node, and the node, to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")) \
            .unionByName(least.select("a", F.col("least").alias("b"))).distinct()
        pairs = stored(small, "links", 2 * before[0])
        now = state(pairs)
        if now == before:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = now


def _leftover(groups: DataFrame, found: DataFrame, sets: DataFrame, percent: int, needed: int) -> DataFrame:
    """Links between documents outside their hub's component and the rest of the hub's group."""
    own = groups.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    hubs = found.select(F.col("node").alias("hub"), F.col("component").alias("hub_component"))
    own = own.join(hubs, "hub", "left").withColumn("outside", F.col("component") != F.coalesce("hub_component", "hub"))
    own = stored(own.select("hub", "node", "component", "outside"), "groups", groups.count())
    sizes = own.groupBy("hub").agg(F.count("*").alias("n"), F.count(F.when(F.col("outside"), 1)).alias("n_outside")) \
        .where("n_outside > 0 AND n > 2")
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    # Few hubs have anybody outside; sent to the rows, so that no hub's whole group meets in one task.
    rows = own.join(broadcast_if_small(sizes, MANY_NODES), "hub").withColumn("draw", F.xxhash64("node"))
    every = lambda n: F.explode(F.sequence(F.lit(0), blocks(n) - 1))
    # Documents outside are one side of a block, all documents of the group the other.
    one = rows.where("outside").select("hub", "node", "component", F.lit(True).alias("outside"),
                                       F.pmod("draw", blocks("n_outside")).cast("int").alias("row"), every("n").alias("column"))
    all_of = rows.select("hub", "node", "component", F.lit(False).alias("outside"),
                         every("n_outside").alias("row"), F.pmod("draw", blocks("n")).cast("int").alias("column"))
    laid = one.unionByName(all_of).join(sets, "node")
    return laid.groupBy("hub", "row", "column").applyInArrow(_compare(percent, needed), "a BIGINT, b BIGINT")


def _beside_hubs(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """``hub, node, members, hub_members``. The members of a large group are dealt to parts of about ``BLOCK``
    documents, each with a copy of the hub's set, so that no task meets the whole group."""
    parts = F.ceil(F.col("n") / BLOCK).cast("int")
    sizes = groups.groupBy("hub").agg(F.count("*").alias("n")).where("n > 1")
    large = broadcast_if_small(sizes.where(F.col("n") > BLOCK).select("hub", parts.alias("parts")), MANY_NODES)
    dealt = groups.where("hub <> node").join(large, "hub", "left").withColumn(
        "part", F.pmod(F.xxhash64("node"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
    hubs = sizes.select("hub", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part")).join(
        sets.select(F.col("node").alias("hub"), F.col("members").alias("hub_members")), "hub")
    return dealt.join(sets.select("node", "members"), "node").join(hubs, ["hub", "part"]).drop("part")


def clustered(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    needed = matches(percent)
    texts = docs.select("doc_id", "text")
    signed = stored(in_files(texts.mapInArrow(
        _signed(size), "doc_id BIGINT, n_shingles BIGINT, digest BINARY, signature ARRAY<INT>"), docs.count()), "signatures")
    known = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stored(known.groupBy("digest").agg(F.min(F.struct("doc_id", "signature")).alias("first")).select(
        "digest", F.col("first.doc_id").alias("node"), F.col("first.signature").alias("signature")), "classes", signed.count())

    n = classes.count()
    groups = stored(hub_groups(classes.select("node", "signature"), needed, n), "hub-groups", n)
    wanted = broadcast_if_small(groups.select("node").union(groups.select("hub")).distinct(), MANY_NODES)
    sets = texts.join(wanted, texts["doc_id"] == wanted["node"], "left_semi").mapInArrow(
        _sets(size), "node BIGINT, signature ARRAY<INT>, members BINARY")
    sets = stored(in_files(sets.where(F.length("members") > 0), docs.count()), "sets")

    met = _beside_hubs(groups, sets)
    star = stored(met.mapInArrow(_confirm(percent), "hub BIGINT, node BIGINT, linked BOOLEAN").where("linked")
                  .select(F.col("hub").alias("a"), F.col("node").alias("b")), "star-links")
    found = components(star, n)
    rest = stored(_leftover(groups, found, sets, percent, needed), "rest-links", n)
    if not rest.isEmpty():
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(rest))

    whole = classes.select("digest", "node").join(found, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("component_id"))
    # Rows of one id may lie in several classes; those are one component then.
    joined = known.select("doc_id", "digest").join(whole, "digest").groupBy("doc_id").agg(
        F.min("component_id").alias("least"), F.max("component_id").alias("most"))
    split = joined.where("least <> most")
    if not split.isEmpty():
        links = known.select("doc_id", "digest").join(split.select("doc_id"), "doc_id").join(whole, "digest").select(
            F.col("doc_id").alias("a"), F.col("component_id").alias("b"))
        merged = components(links)
        joined = joined.join(merged, joined["least"] == merged["node"], "left").select(
            "doc_id", F.coalesce("component", "least").alias("least"))
    ids = joined.select("doc_id", F.col("least").alias("component_id"))
    return signed.select("doc_id", "n_shingles").join(ids, "doc_id", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, with its columns; equal rows of it count once."""
    found = clustered(docs, size, percent)
    named = found.where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_kept")).distinct()
    kept = docs.where("doc_id IS NOT NULL").join(named, F.col("doc_id") == F.col("_kept"), "left_semi")
    hashed = kept.withColumn("_text", F.xxhash64("text")).dropDuplicates(["doc_id", "_text"]).drop("_text")
    return hashed.unionByName(docs.where("doc_id IS NULL"))
