"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from overflight.session import scratch_path

# The white space and the word classes of the contracts.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KELVIN = "\u212a"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ROWS_PER_READ = 256


def light_reads(spark: SparkSession) -> None:
    """Files are read some rows at a time, or the texts of 4,096 rows lie in one buffer that is copied as it grows."""
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(ROWS_PER_READ))


def text_of(col: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def space_words(text: Column) -> Column:
    """Runs of characters other than space and 0x09 to 0x0D."""
    return F.array_remove(F.split(text, SPACE), "")


def alnum_words(text: Column) -> Column:
    """Lower-cased runs of letters, digits and non-ASCII characters.

    ``lower`` also folds letters beyond ASCII. That cannot make such a word
    equal to an ASCII one: the only character that folds to plain ASCII alone,
    the Kelvin sign, is replaced first.
    """
    plain = F.lower(F.replace(text, F.lit(KELVIN), F.lit("\ufffd")))
    return F.array_remove(F.split(plain, NOT_ALNUM), "")


def row_key() -> list[Column]:
    """Tells documents apart: the id and a hash of the text. Equal rows share it."""
    return [F.col("doc_id"), F.xxhash64(F.col("text"), F.col("text").isNull()).alias("text_hash")]


def remainder(col: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


ROWS_PER_FILE = 50_000
DOCS_PER_FILE = 20_000


def in_files(df: DataFrame, rows: int, per_file: int = DOCS_PER_FILE) -> DataFrame:
    """About ``rows`` rows in no more partitions than that takes, however many they come in: a file each, when
    they are written, and every file costs its task a few processes of the file system's."""
    return df.coalesce(rows // per_file + 1)


def stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write to the shared folder and read back, so that a lost executor costs no recomputation.

    ``rows``, where it is known about how many narrow rows there are, keeps the number of files down.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df if rows is None else in_files(df, rows, ROWS_PER_FILE)).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, most_rows: int) -> DataFrame:
    """Hint a broadcast where a count has shown that the rows are few; else leave the join to Spark."""
    return F.broadcast(df) if fits(df, most_rows) else df


def fits(df: DataFrame, most_rows: int) -> bool:
    return df.limit(most_rows + 1).count() <= most_rows


def portions(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of one piece have about ``most_bytes``; a longer text is alone."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        first, held = 0, 0
        for i, length in enumerate(lengths):
            if held and held + length > most_bytes:
                yield batch.slice(first, i - first)
                first, held = i, 0
            held += length
        if len(lengths) > first:
            yield batch.slice(first)
