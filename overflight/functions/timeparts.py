"""Time expressions on TIMESTAMP columns in a UTC session."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F


def time_bucket(ts: Column | str, seconds: int) -> Column:
    """Start of the ``seconds``-wide bucket that holds ``ts``."""
    epoch = F.unix_seconds(ts)
    return F.timestamp_seconds(epoch - epoch % F.lit(seconds))


def day_of(df: DataFrame, ts: str = "snapshot_time") -> Column:
    """UTC day of a row: the ``dt`` partition column if there is one, so that
    filters on it prune files, else the day of ``ts``."""
    return F.col("dt") if "dt" in df.columns else F.to_date(ts)


def compact_day(epoch: Column | str) -> Column:
    """Epoch seconds -> ``yyyyMMdd`` (UTC)."""
    return F.date_format(F.timestamp_seconds(epoch), "yyyyMMdd")


def iso_seconds(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def age_seconds(as_of: datetime, ts: Column | str) -> Column:
    """Whole seconds from ``ts`` to ``as_of``."""
    return F.timestamp_diff("SECOND", ts, instant(as_of))


def instant(at: datetime) -> Column:
    """Literal TIMESTAMP; a naive datetime is taken as UTC."""
    if at.tzinfo is None:
        at = at.replace(tzinfo=timezone.utc)
    return F.timestamp_micros(F.lit(round(at.timestamp() * 1_000_000)))


def utc(at: datetime) -> datetime:
    """The same instant in UTC; a naive datetime is taken as UTC."""
    return at.astimezone(timezone.utc) if at.tzinfo else at


def utc_day(at: datetime | date) -> date:
    return utc(at).date() if isinstance(at, datetime) else at


def humanize_duration(seconds: Column | str) -> Column:
    """``93784`` -> ``1d 2h 3m 4s``; leading zero units are left out."""
    value = F.col(seconds) if isinstance(seconds, str) else seconds
    whole = F.floor(F.abs(value)).cast("bigint")
    days = F.floor(whole / 86400).cast("bigint")
    hours = F.floor(whole % 86400 / 3600).cast("bigint")
    minutes = F.floor(whole % 3600 / 60).cast("bigint")
    rest = whole % 60
    sign = F.when(value < 0, "-").otherwise("")
    short = F.regexp_replace(F.round(F.abs(value), 2).cast("string"), r"\.0$", "")
    text = (
        F.when(days > 0, F.format_string("%dd %dh %dm %ds", days, hours, minutes, rest))
        .when(hours > 0, F.format_string("%dh %dm %ds", hours, minutes, rest))
        .when(minutes > 0, F.format_string("%dm %ds", minutes, rest))
        .otherwise(F.concat(short, F.lit("s")))
    )
    return F.concat(sign, text)
