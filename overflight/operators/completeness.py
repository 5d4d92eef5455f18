"""Freshness and completeness of bronze and marts at a given instant."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from overflight.functions.timeparts import age_seconds, day_of, utc, utc_day
from overflight.sources.reference import day_spine


def recent_days(df: DataFrame, as_of: datetime, days: int, closed_only: bool = False, ts: str = "snapshot_time") -> DataFrame:
    """Rows of day ``as_of - days`` and later; ``closed_only`` leaves out the
    current day. Filters the day column where there is one, which prunes files."""
    today = utc_day(as_of)
    day = day_of(df, ts)
    recent = df.where(day >= F.lit(today - timedelta(days=days)))
    return recent.where(day < F.lit(today)) if closed_only else recent


def lately(df: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Rows of the last days, or all rows if there are none: whoever asks for
    the newest day then opens no older files. Looks whether a row exists."""
    recent = recent_days(df, as_of, days)
    return df if recent.isEmpty() else recent


def incomplete_days(bronze: DataFrame, as_of: datetime, days: int = 3, threshold: int = 115) -> DataFrame:
    """Closed days of the window with fewer than ``threshold`` snapshots of a
    region. A snapshot counts once, in however many documents it came; the
    ledger of bronze has them counted. A day without any row forms no group;
    ``missing_days`` reports it."""
    window = recent_days(bronze, as_of, days, closed_only=True)
    counted = F.sum("snapshots") if "snapshots" in bronze.columns else F.count_distinct("region", "snapshot_time")
    return (
        window.groupBy(day_of(window).alias("dt"))
        .agg(counted.alias("snapshot_cnt"))
        .where(F.col("snapshot_cnt") < threshold)
        .orderBy("dt")
    )


def completeness_message(incomplete: DataFrame, threshold: int = 115) -> DataFrame:
    """One row ``message`` listing the incomplete days, no row without any.
    At most one entry per day of the window."""
    entry = F.format_string(f"%s=%d/{threshold}", F.col("dt").cast("string"), F.col("snapshot_cnt"))
    return (
        incomplete.agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.struct("dt", entry.alias("text")))).alias("e"))
        .where(F.col("n") > 0)
        .select(F.array_join(F.col("e.text"), ", ").alias("message"))
    )


def missing_days(bronze: DataFrame, as_of: datetime, days: int = 3) -> DataFrame:
    """Closed days of the window without a single bronze row."""
    today = utc_day(as_of)
    window = recent_days(bronze, as_of, days, closed_only=True)
    spine = day_spine(bronze.sparkSession, today - timedelta(days=days), today - timedelta(days=1))
    seen = window.groupBy(day_of(window).alias("dt")).agg(F.lit(1).alias("_seen")).select("dt")
    return spine.join(seen, "dt", "left_anti")


def daily_health(bronze: DataFrame, as_of: datetime, days: int = 7, expected: int = 144) -> DataFrame:
    """Distinct snapshots per day of the window, today included but not judged."""
    window = recent_days(bronze, as_of, days)
    return (
        window.groupBy(day_of(window).alias("dt"))
        .agg(F.countDistinct("snapshot_time").alias("snaps"))
        .withColumn(
            "status",
            F.when(F.col("dt") == F.lit(utc_day(as_of)), "excluded")
            .when(F.col("snaps") < expected, "missing data")
            .otherwise("ok"),
        )
    )


def mart_freshness(mart: DataFrame, as_of: datetime, ready_minute: int = 65) -> DataFrame:
    """One row: newest mart day against yesterday, or the day before as long
    as today's build is not due (``ready_minute`` minutes after midnight)."""
    today, at = utc_day(as_of), utc(as_of)
    due = at.hour * 60 + at.minute >= ready_minute
    day = F.col("newest_day")
    fresh = day == F.lit(today - timedelta(days=1))
    if not due:
        fresh = fresh | (day == F.lit(today - timedelta(days=2)))
    return lately(mart, as_of).agg(F.max("snapshot_time").alias("newest")).select(
        "newest",
        F.to_date("newest").alias("newest_day"),
    ).withColumn("status", F.when(day.isNull(), "empty").when(fresh, "ok").otherwise("stale"))


def freshness_status(
    bronze: DataFrame, as_of: datetime, warn_s: int = 36 * 3600, error_s: int = 48 * 3600
) -> DataFrame:
    """One row: age of the newest load; above the limits warn, then error.
    An empty table is an error. A load of an old day is a load too, so this
    looks at all days: give it the ledger of bronze, not bronze."""
    age = F.col("age_seconds")
    return (
        bronze.agg(F.max("_loaded_at").alias("newest_load"))
        .withColumn("age_seconds", age_seconds(as_of, "newest_load"))
        .withColumn(
            "status",
            F.when(age.isNull() | (age > error_s), "error").when(age > warn_s, "warn").otherwise("pass"),
        )
    )


def _check(name: str, df: DataFrame, failed: Column) -> DataFrame:
    return df.agg(F.lit(name).alias("check_name"), F.count_if(failed).alias("failures"))


def health_checks(
    bronze: DataFrame,
    mart: DataFrame,
    as_of: datetime,
    *,
    ingest: DataFrame | None = None,
    days: int = 7,
    expected: int = 144,
    ready_minute: int = 65,
) -> DataFrame:
    """One row per check; every check is evaluated whatever the others find."""
    checks = [
        _check("daily_snapshots", daily_health(bronze, as_of, days, expected), F.col("status") == "missing data"),
        _check("yesterday_loaded", missing_days(bronze, as_of, 1), F.lit(True)),
        _check("mart_freshness", mart_freshness(mart, as_of, ready_minute), F.col("status") != "ok"),
    ]
    if ingest is not None:
        checks.append(_check("ingest", ingest, F.col("status") != "ok"))
    return reduce(DataFrame.unionByName, checks)


def health_verdict(checks: DataFrame) -> DataFrame:
    """One row: 1 if any check failed, else 0."""
    return checks.agg(
        F.max(F.when(F.col("failures") > 0, 1).otherwise(0)).cast("bigint").alias("verdict"),
        F.count("*").alias("checks_run"),
        F.count_if(F.col("failures") > 0).alias("checks_failed"),
    )
