"""Map points and what the map needs from them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from overflight.config import ADSB
from overflight.functions.timeparts import iso_seconds, time_bucket, utc_day
from overflight.operators.density import adsb_only, airborne, located


def thin_frames(df: DataFrame, minutes: Sequence[int] = (0, 30), ts: str = "snapshot_time") -> DataFrame:
    """Keep snapshots taken in one of the given minutes of the hour."""
    return df.where(F.minute(ts).isin(list(minutes)))


def first_frames(df: DataFrame, seconds: int = 1800, ts: str = "snapshot_time") -> DataFrame:
    """Keep the first snapshot of every bucket, whatever its minute. Spark
    picks the join by the number of buckets it finds."""
    first = df.groupBy(time_bucket(ts, seconds).alias("_bucket")).agg(F.min(ts).alias(ts))
    return df.join(first.select(ts), ts, "left_semi")


def aircraft_points(
    stg: DataFrame,
    minutes: Sequence[int] = (0, 30),
    seconds: int = 1800,
    sources: Sequence[int] = (ADSB,),
    first_per_bucket: bool = False,
) -> DataFrame:
    """Airborne positions of the frames, one row per aircraft and frame.

    A plain filter and projection: no shuffle. ``first_per_bucket`` picks
    frames by bucket instead of by minute, for snapshots off the grid.
    """
    frames = first_frames(stg, seconds) if first_per_bucket else thin_frames(stg, minutes)
    return adsb_only(airborne(located(frames)), sources).select(
        time_bucket("snapshot_time", seconds).alias("snapshot_bucket"),
        "snapshot_time",
        "region",
        "longitude",
        "latitude",
        "callsign",
        "origin_country",
        "baro_altitude",
        "velocity",
    )


def recent_points(points: DataFrame, as_of: datetime, days: int = 3) -> DataFrame:
    """Points of the last ``days`` days with the frame as text."""
    start = utc_day(as_of) - timedelta(days=days)
    recent = points.where(F.to_date("snapshot_bucket") >= F.lit(start))
    if "dt" in points.columns:  # frames never cross midnight
        recent = recent.where(F.col("dt") >= F.lit(start))
    return recent.select(
        iso_seconds("snapshot_bucket").alias("ts"),
        "region",
        "longitude",
        "latitude",
        "callsign",
        "origin_country",
        "baro_altitude",
        "velocity",
    )


def export_points(points: DataFrame, as_of: datetime, out: str, days: int = 3, fmt: str = "parquet") -> bool:
    """Write the recent points ordered by frame; keep the old output and
    return False when there are none.

    Position is part of the sort key, so that range partitioning can split a
    frame that is much larger than the others.
    """
    rows = recent_points(points, as_of, days)
    if rows.isEmpty():
        return False
    rows.orderBy("ts", "longitude", "latitude").write.mode("overwrite").format(fmt).save(out)
    return True


def playback_window(points: DataFrame, width: timedelta = timedelta(hours=1), ts: str = "snapshot_bucket") -> DataFrame:
    """Points of the opening window ``[first, first + width]``, both ends included."""
    end = F.min(ts) + F.lit(width)
    return points.where(F.col(ts) <= points.agg(end).scalar())
