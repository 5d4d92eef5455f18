"""Repair of damaged conversations by weighted CYK parsing.

A conversation is legal if the initials of its roles read ``s?(ua)+``, or if it
is empty. Its rows are the word to parse; edits are what the grammar pays for:
keeping a row is free, a new role costs 2, deleting a row 3, inserting an empty
row 2, and a truncated text that stays adds 1. Blank and duplicate rows have to
go. The cheapest sequence of edits wins, the smallest in ASCII order among
equally cheap ones.

The grammar is in Chomsky normal form. Its nonterminals are pairs of states
(nothing yet, after system, after user, after assistant); ``(p, q)`` derives
what leads from p to q, by rules ``(p, q) -> (p, r) (r, q)`` and by one edited
row with any insertions around it (the insertion closure). A cell holds the
least (cost, audit) of each nonterminal over a span. Edits of equal cost over
the same rows are never prefixes of each other (they would differ by paid
insertions alone), so the least of two parts stays the least when they are
joined. These rules derive the same whichever way a span is split, so every
span needs one split: spans are combined bottom-up with their length doubling.
That makes n - 1 products instead of n^3, and lets the spans of one long
conversation be parsed by many tasks: rows are sorted over the whole table,
blocks of ``BLOCK`` consecutive places become one cell each, and the cells of a
conversation are joined in order.

Defined results: a null role, text or part of a key counts as one space. Null
turns come first; rows of one turn are ordered by role and text; a null
conversation id is a conversation of its own. Rows may be repeated (the second
is a duplicate) and texts may have any length. A conversation of which no row is
left has zeros, an empty audit and the hash of the empty string. An empty table
gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from overflight.llm.common import stored

# What edits cost, and the role initials with the states they lead between.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
MOVES = {"s": ((START, SYSTEM),), "u": ((START, USER), (SYSTEM, USER), (ASSISTANT, USER)), "a": ((USER, ASSISTANT),)}
ENDS = (START, ASSISTANT)
BLANK = r"[^\x20\x09-\x0D]"
WHOLE = r"[.!?][\x20\x09-\x0D]*\z"
BLOCK_BITS = 12

Cell = dict[tuple[int, int], tuple[int, str]]
PAIRS = [(p, q) for p in range(4) for q in range(4)]


def _least(cells: Iterator[tuple[tuple[int, int], tuple[int, str]]]) -> Cell:
    out: Cell = {}
    for pair, found in cells:
        if pair not in out or found < out[pair]:
            out[pair] = found
    return out


def product(left: Cell, right: Cell) -> Cell:
    """The cell of two spans side by side: ``(p, q) -> (p, r) (r, q)``."""
    return _least(((p, q), (c + d, a + b)) for (p, r), (c, a) in left.items() for (s, q), (d, b) in right.items() if r == s)


@cache
def insertions() -> Cell:
    """Inserted rows alone, any number of them."""
    one = {move: (INSERT, "I") for initial in "ua" for move in MOVES[initial]}
    found: Cell = {(p, p): (0, "") for p in range(4)}
    while True:
        more = _least([*found.items(), *product(found, one).items()])
        if more == found:
            return found
        found = more


@cache
def row_cell(symbol: str) -> Cell:
    """One edited row with insertions around it. A symbol is the role's initial and ``-``, ``t`` (truncated) or ``d`` (has to go)."""
    initial, fault = symbol
    edits = [((p, p), (DELETE, "D")) for p in range(4)]
    if fault != "d":
        more = TRUNCATED if fault == "t" else 0
        edits += [(move, (KEEP + more, "K")) for move in MOVES.get(initial, ())]
        edits += [(move, (REROLE + more, "R")) for other in "ua" for move in MOVES[other]]
    return product(product(insertions(), _least(edits)), insertions())


def parsed(cells: list[Cell]) -> Cell:
    """The cell of a whole span, bottom-up: spans of one, two, four ... of the given cells."""
    while len(cells) > 1:
        pairs = [product(a, b) for a, b in zip(cells[::2], cells[1::2])]
        cells = pairs + cells[len(pairs) * 2:]
    return cells[0] if cells else insertions()


def cheapest(cell: Cell) -> tuple[int, str]:
    return min(cell[START, q] for q in ENDS if (START, q) in cell)


def _runs(batches: Iterator[pa.RecordBatch], *key: str) -> Iterator[list[dict]]:
    """Neighbouring rows with the same key."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and any(row[k] != held[0][k] for k in key):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


_BLOCK_CELLS = pa.schema([("conv_id", pa.int64()), ("at", pa.int64()), ("first", pa.string()), ("last", pa.string()),
                          ("illegal", pa.int64()), ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))])
_PARSES = pa.schema([("conv_id", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())])
FOLLOWS = ("su", "ua", "au")


def _batched(rows: Iterator[dict], schema: pa.Schema, most: int = 1000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _block_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Symbols of a block in order in, the block's cell out."""

    def cells() -> Iterator[dict]:
        for rows in _runs(batches, "conv_id", "block"):
            symbols = [r["symbol"] for r in rows]
            cell = parsed(list(map(row_cell, symbols)))
            initials = [s[0] for s in symbols]
            yield {"conv_id": rows[0]["conv_id"], "at": rows[0]["at"], "first": initials[0], "last": initials[-1],
                   "illegal": sum(a + b not in FOLLOWS for a, b in zip(initials, initials[1:])),
                   "costs": [cell[p][0] if p in cell else None for p in PAIRS],
                   "audits": [cell[p][1] if p in cell else None for p in PAIRS]}

    return _batched(cells(), _BLOCK_CELLS)


def _parses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Block cells of a conversation in order in, its parse out."""

    def parses() -> Iterator[dict]:
        for rows in _runs(batches, "conv_id"):
            cells = [{p: (c, a) for p, c, a in zip(PAIRS, r["costs"], r["audits"]) if c is not None} for r in rows]
            cost, audit = cheapest(parsed(cells))
            between = sum(a["last"] + b["first"] not in FOLLOWS for a, b in zip(rows, rows[1:]))
            yield {"conv_id": rows[0]["conv_id"], "illegal": sum(r["illegal"] for r in rows) + between, "cost": cost, "audit": audit}

    return _batched(parses(), _PARSES, 100)


def applied(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired rows: (role, text)."""
    state = START
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if state == USER else "user"
        state = dict(MOVES[role[0]])[state]
        yield role, text


_REPAIRED = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A conversation's audit, then its rows in order in; the digest of the repaired rows out. Holds one row at a time."""
    stream = (row for batch in batches for row in batch.to_pylist())

    def digests() -> Iterator[dict]:
        head = next(stream, None)
        while head is not None:
            digest, begun, after = hashlib.sha256(), False, [None]

            def rows(conv: int | None = head["conv_id"], after: list = after) -> Iterator[tuple[str, str]]:
                for row in stream:
                    if row["at"] < 0:
                        after[0] = row
                        return
                    yield row["role"], row["text"]

            left = rows()
            for role, text in applied(head["text"], left):
                digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
                begun = True
            for _ in left:  # none, as an audit names all rows; moves on to the next head
                raise ValueError("rows without an edit")
            yield {"conv_id": head["conv_id"], "repaired_sha256": digest.hexdigest()}
            head = after[0]

    return _batched(digests(), _REPAIRED)


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults drawn from their keys, to repair: ``conv_id, turn, role, text``."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    drawn = F.pmod(F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")), F.lit(20))
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), drawn.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1)))
    return rows.where("fault <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def _symbol(initial: Column, gone: Column, truncated: Column) -> Column:
    fault = F.when(gone, "d").when(truncated, "t").otherwise("-")
    return F.concat(F.when(initial.isin(*MOVES), initial).otherwise("x"), fault)


def repaired(rows: DataFrame) -> DataFrame:
    """One row per conversation with rows: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    space = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role"), space("text"))
    ordered = stored(rows.orderBy("conv_id", "turn", "role", "text").withColumn("at", F.monotonically_increasing_id()), "turns")

    # The first of equal rows is known by its place, so that no join meets all copies of a row in one task.
    same = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    firsts = ordered.groupBy("conv_id", same.alias("same")).agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    facts = ordered.select(
        "conv_id", "turn", "at", F.substring("role", 1, 1).alias("initial"), (~F.col("text").rlike(BLANK)).alias("blank"),
        (~F.col("text").rlike(WHOLE)).alias("open"))
    marked = facts.join(firsts, "at", "left").withColumn("duplicate", ~F.col("blank") & F.col("first").isNull()) \
        .withColumn("truncated", ~F.col("blank") & ~F.col("duplicate") & F.col("open"))
    marked = stored(marked.select(
        "conv_id", "turn", "at", "blank", "duplicate", "truncated",
        _symbol(F.col("initial"), F.col("blank") | F.col("duplicate"), F.col("truncated")).alias("symbol")), "turn-faults")

    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    totals = marked.groupBy("conv_id").agg(
        F.coalesce(span, F.lit(0)).alias("gaps"), *[F.count_if(F.col(c)).alias(c) for c in ("blank", "duplicate", "truncated")])

    symbols = marked.select("conv_id", "at", F.shiftright("at", BLOCK_BITS).alias("block"), "symbol")
    cells = symbols.repartition("conv_id", "block").sortWithinPartitions("conv_id", "at").mapInArrow(
        _block_cells, "conv_id BIGINT, at BIGINT, first STRING, last STRING, illegal BIGINT, costs ARRAY<BIGINT>, audits ARRAY<STRING>")
    parses = stored(cells.repartition("conv_id").sortWithinPartitions("conv_id", "at").mapInArrow(
        _parses, "conv_id BIGINT, illegal BIGINT, cost BIGINT, audit STRING"), "parses")

    heads = parses.select("conv_id", F.lit(-1).cast("long").alias("at"), F.lit("").alias("role"), F.col("audit").alias("text"))
    digests = heads.unionByName(ordered.select("conv_id", "at", "role", "text")).repartition("conv_id") \
        .sortWithinPartitions("conv_id", "at").mapInArrow(_digests, "conv_id BIGINT, repaired_sha256 STRING")
    return _beside(_beside(totals, parses), digests).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _beside(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Joined by conversation; the null id is one."""
    right = right.withColumnRenamed("conv_id", "_conv")
    return left.join(right, left["conv_id"].eqNullSafe(right["_conv"]), how).drop("_conv")


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """What the repair finds in damaged conversations; also conversations that lost all rows."""
    every = conversations.select("conv_id").distinct()
    found = _beside(every, repaired(damaged(conversations)), "left")
    empty = hashlib.sha256(b"").hexdigest()
    return found.select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in (
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
