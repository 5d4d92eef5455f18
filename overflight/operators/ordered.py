"""Runs of a condition in long series without one task per series.

A plain window over a whole series puts a hot key into one task. Here the
window runs inside (key, time chunk) pieces, and what the earlier pieces
contribute is carried over, one summary row per piece.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

CHUNK_SECONDS = 86_400


def _chunked(df: DataFrame, ts: str, seconds: int) -> DataFrame:
    return df.withColumn("_chunk", F.floor(F.unix_micros(ts) / (seconds * 1_000_000)).cast("bigint"))


def _join_pieces(inside: DataFrame, pieces: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the carried columns of ``pieces`` to the rows of each piece."""
    names = [*keys, "_chunk"]
    renamed = pieces.withColumnsRenamed({name: f"_of_{name}" for name in names})
    match = reduce(Column.__and__, [F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in names])
    return inside.join(renamed, match, "left")


def with_runs(
    df: DataFrame, keys: Sequence[str], ts: str, holds: str, max_gap_s: int | None = None, seconds: int = CHUNK_SECONDS
) -> DataFrame:
    """Add ``was_held`` and ``prev_ts`` of the previous sample and
    ``active_since``, the start of the current or last run of ``holds``.

    A run starts where ``holds`` turns true or, after a gap above
    ``max_gap_s``, is true again. Inside a piece the starts are known except
    for the first sample's, which the piece before decides. A column ``since``,
    if there is one, gives the start for samples whose past is not at hand.
    """

    def start(prev: Column, here: Column) -> Column:
        new = ~F.coalesce(prev["holds"], F.lit(False))
        if max_gap_s is not None:
            new = new | F.coalesce(F.timestamp_diff("SECOND", prev["ts"], here["ts"]) > max_gap_s, F.lit(False))
        return F.coalesce(here["since"], F.when(here["holds"] & new, here["ts"]))

    since = F.col("since") if "since" in df.columns else F.lit(None).cast("timestamp")
    here = F.struct(F.col(holds).alias("holds"), F.col(ts).alias("ts"), since.alias("since"))
    piece = Window.partitionBy(*keys, "_chunk").orderBy(ts)
    inside = (
        _chunked(df, ts, seconds)
        .withColumn("_here", here)
        .withColumn("_prev", F.lag("_here").over(piece))
        .withColumn("_start", F.when(F.col("_prev").isNotNull(), start(F.col("_prev"), F.col("_here"))))
        .withColumn("_upto", F.max("_start").over(piece.rowsBetween(Window.unboundedPreceding, 0)))
    )
    pieces = inside.groupBy(*keys, "_chunk").agg(
        F.min_by("_here", ts).alias("_first"), F.max_by("_here", ts).alias("_last"), F.max("_start").alias("_top")
    )
    order = Window.partitionBy(*keys).orderBy("_chunk")
    pieces = pieces.withColumn("_before", F.lag("_last").over(order)).withColumn(
        "_entry", start(F.col("_before"), F.col("_first"))
    )
    pieces = pieces.withColumn(
        "_past", F.max(F.greatest("_top", "_entry")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    ).select(*keys, "_chunk", "_before", F.greatest("_past", "_entry").alias("_carry"))
    prev = F.coalesce(F.col("_prev"), F.col("_before"))
    return _join_pieces(inside, pieces, keys).select(
        *df.columns,
        prev["holds"].alias("was_held"),
        prev["ts"].alias("prev_ts"),
        F.greatest("_upto", "_carry").alias("active_since"),
    )


def with_next(df: DataFrame, keys: Sequence[str], ts: str, value: str, name: str, seconds: int = CHUNK_SECONDS) -> DataFrame:
    """Add ``name``: ``value`` of the key's next row in the order of ``ts``, NULL for the last one.

    Looked up inside (key, time chunk) pieces; the last row of a piece takes it
    from the first row of the next piece.
    """
    piece = Window.partitionBy(*keys, "_chunk").orderBy(ts)
    inside = _chunked(df, ts, seconds).withColumn("_inside", F.lead(value).over(piece)).withColumn(
        "_last", F.lead(F.lit(True)).over(piece).isNull())
    pieces = inside.groupBy(*keys, "_chunk").agg(F.min_by(value, ts).alias("_first"))
    order = Window.partitionBy(*keys).orderBy("_chunk")
    pieces = pieces.withColumn("_next", F.lead("_first").over(order)).drop("_first")
    following = F.when(F.col("_last"), F.col("_next")).otherwise(F.col("_inside"))
    return _join_pieces(inside, pieces, keys).select(*df.columns, following.alias(name))
