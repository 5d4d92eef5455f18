"""The bronze table: one row per snapshot, payload kept as it came."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from overflight.functions.timeparts import instant, utc_day
from overflight.schemas import BRONZE_SCHEMA
from overflight.sources import ledger
from overflight.sources.raw import latest_per_snapshot, read_raw
from overflight.sources.storage import guard_day, read_table, write_days


def snapshot_epoch(mode: str) -> Column:
    """``time`` of the document. A value with more than one document, or with
    anything after it, is no array of one object once it stands in brackets."""
    text = F.btrim("value", F.lit(" \t\r\n"))
    parsed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "ARRAY<STRUCT<time: BIGINT>>", {"mode": mode})
    one = text.startswith("{") & text.endswith("}") & (F.size(parsed) == 1)
    return F.when(one, F.get(parsed, F.lit(0))["time"])


def to_bronze(
    raw: DataFrame, loaded_at: datetime | None = None, mode: str = "FAILFAST", keep: Sequence[str] = ()
) -> DataFrame:
    """Wrap documents in the envelope ``snapshot_time, region, raw, _loaded_at, dt``.

    FAILFAST stops the whole load on a bad document or a missing ``time``;
    PERMISSIVE skips such rows, which ``quarantine`` returns. Columns named in
    ``keep`` are passed through.
    """
    epoch = snapshot_epoch(mode)
    if mode == "FAILFAST":
        epoch = F.coalesce(epoch, F.raise_error(F.lit("document is not a JSON object with a time")).cast("bigint"))
    stamped = raw.select(
        F.timestamp_seconds(epoch).alias("snapshot_time"),
        "region",
        F.col("value").alias("raw"),
        (F.current_timestamp() if loaded_at is None else instant(loaded_at)).alias("_loaded_at"),
        *keep,
    )
    if mode != "FAILFAST":
        stamped = stamped.where(F.col("snapshot_time").isNotNull())
    return stamped.withColumn("dt", F.to_date("snapshot_time"))


def quarantine(raw: DataFrame) -> DataFrame:
    """The documents a PERMISSIVE load skips."""
    return raw.where(snapshot_epoch("PERMISSIVE").isNull())


def write_bronze(df: DataFrame, path: str, dt: date | Column) -> None:
    """Replace exactly day ``dt``. A row of another day fails the job before
    anything is replaced; no rows leave the stored day as it is."""
    day = guard_day(df, dt)
    write_days(day.select("snapshot_time", "region", "raw", "_loaded_at", "dt"), path)


def read_bronze(spark: SparkSession, path: str, days: Sequence[date] | None = None) -> DataFrame:
    """Bronze, loaded by day or by piece."""
    bronze = read_table(spark, path, BRONZE_SCHEMA).select(*[field.split()[0] for field in BRONZE_SCHEMA.split(", ")])
    return bronze if days is None else bronze.where(F.col("dt").isin(list(days)))


def resolve_dt(logical_date: datetime | date, override: str | None = None) -> str:
    """Day to load as ``yyyyMMdd``: the override, else the last closed day."""
    return override or (utc_day(logical_date) - timedelta(days=1)).strftime("%Y%m%d")


def load_days(
    spark: SparkSession,
    root: str,
    bronze_path: str,
    dts: Sequence[str],
    *,
    regions: Sequence[str] | None = None,
    pattern: str = "*.json",
    packed: bool = False,
    loaded_at: datetime | None = None,
) -> None:
    """Load raw days into bronze in one job, each day replaced as a whole.

    Every document must belong to the day of the folder it lies in. The load
    ends with the ledger rows of these days, which readers ask instead of bronze.
    """
    raw = read_raw(spark, root, dts, regions, pattern=pattern, wholetext=not packed)
    if packed:
        raw = latest_per_snapshot(raw)
    bronze = to_bronze(raw.withColumnRenamed("dt", "folder"), loaded_at, keep=("folder",))
    write_bronze(bronze, bronze_path, F.to_date("folder", "yyyyMMdd"))
    note_load(spark, bronze_path, [date(int(d[:4]), int(d[4:6]), int(d[6:])) for d in dts])


def note_load(spark: SparkSession, bronze_path: str, days: Sequence[date] | None = None) -> None:
    """Write the ledger rows of these days as bronze holds them now; None for all days."""
    ledger.record(ledger.entries(read_bronze(spark, bronze_path, days)), bronze_path)


def backfill(spark: SparkSession, root: str, bronze_path: str, start: date, end: date, **options) -> None:
    """Load every day of the closed range ``[start, end]`` that has files."""
    days = [(start + timedelta(days=n)).strftime("%Y%m%d") for n in range((end - start).days + 1)]
    load_days(spark, root, bronze_path, days, **options)
