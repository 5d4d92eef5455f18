"""A load ledger: what each piece of a bronze table holds, in a few numbers.

A load writes one row per (day, region, piece of six hours) into a table beside
bronze: documents, snapshots, newest load and a fingerprint. Freshness, latest
and missing days and the question whether a day changed are answered from
these rows, without opening a file of the table. The rows of a day are
replaced as a whole, so a retry or a reload never counts twice. Pieces are
disjoint, so counts add up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from overflight.sources.storage import read_table

LEDGER_SCHEMA = (
    "documents BIGINT, snapshots BIGINT, _loaded_at TIMESTAMP, fingerprint DECIMAL(38,0), dt DATE, region STRING, hour INT"
)
PIECE = ("dt", "region", "hour")
PIECE_HOURS = 6


def ledger_path(bronze_path: str) -> str:
    return f"{bronze_path.rstrip('/')}-ledger"


def piece_hour(ts: str = "snapshot_time") -> Column:
    """The hour in which the piece of a day begins that ``ts`` lies in."""
    hour = F.hour(ts)
    return hour - hour % F.lit(PIECE_HOURS)


def row_fingerprint() -> Column:
    """A hash of what a document says, not of when it was loaded."""
    return F.xxhash64("snapshot_time", "region", "raw").cast("decimal(38,0)")


def entries(bronze: DataFrame) -> DataFrame:
    """Ledger rows of bronze rows. The fingerprint is a sum, so the order of rows does not matter and parts add up."""
    return bronze.groupBy("dt", "region", piece_hour().alias("hour")).agg(
        F.count("*").alias("documents"),
        F.count_distinct("snapshot_time").alias("snapshots"),
        F.max("_loaded_at").alias("_loaded_at"),
        F.sum(row_fingerprint()).cast("decimal(38,0)").alias("fingerprint"),
    )


def record(rows: DataFrame, bronze_path: str) -> None:
    """Replace the ledger rows of the days in ``rows``."""
    (
        rows.coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt")
        .parquet(ledger_path(bronze_path))
    )


def read_ledger(spark: SparkSession, bronze_path: str) -> DataFrame:
    names = [field.split()[0] for field in LEDGER_SCHEMA.split(", ")]
    return read_table(spark, ledger_path(bronze_path), LEDGER_SCHEMA).select(*names)


def days(ledger: DataFrame) -> DataFrame:
    """One row per day: documents, snapshots, newest load, fingerprint."""
    return ledger.groupBy("dt").agg(
        F.sum("documents").alias("documents"),
        F.sum("snapshots").alias("snapshots"),
        F.max("_loaded_at").alias("_loaded_at"),
        F.sum("fingerprint").cast("decimal(38,0)").alias("fingerprint"),
    )
