"""Windowed aggregates over a stream of staged rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from overflight.config import ADSB
from overflight.operators.density import adsb_only, airborne, located
from overflight.operators.points import thin_frames


def region_density(
    stg: DataFrame, areas: DataFrame, *, sources: Sequence[int] = (ADSB,), delay: str = "1 hour"
) -> DataFrame:
    """Airborne count and density per (snapshot, region); ``areas`` is static.
    State of a snapshot is dropped once the watermark has passed it."""
    counts = (
        adsb_only(airborne(stg), sources)
        .withWatermark("snapshot_time", delay)
        .join(areas, "region")
        .groupBy("snapshot_time", "region", "area_sqdeg")
        .agg(F.count("*").alias("aircraft_count"))
    )
    return counts.select(
        "snapshot_time",
        "region",
        "aircraft_count",
        "area_sqdeg",
        F.round(F.col("aircraft_count") / F.col("area_sqdeg"), 4).alias("density"),
    )


def frames(
    stg: DataFrame, *, sources: Sequence[int] = (ADSB,), minutes: Sequence[int] = (0, 30), width: str = "30 minutes",
    delay: str = "1 hour",
) -> DataFrame:
    """Airborne rows per (frame, region), of the snapshots the map shows."""
    return (
        thin_frames(adsb_only(airborne(located(stg)), sources), minutes)
        .withWatermark("snapshot_time", delay)
        .groupBy(F.window("snapshot_time", width).alias("w"), "region")
        .agg(F.count("*").alias("aircraft_count"))
        .select(F.col("w.start").alias("frame"), "region", "aircraft_count")
    )


def coverage(stg: DataFrame, *, expected: int = 144, delay: str = "1 hour") -> DataFrame:
    """Daily coverage. Distinct counts do not exist on streams: repeats of a
    snapshot time are dropped first, then days are counted. In append mode a
    day comes out once, when the watermark has passed its end."""
    seen = stg.select("snapshot_time").withWatermark("snapshot_time", delay).dropDuplicates(["snapshot_time"])
    return (
        seen.groupBy(F.window("snapshot_time", "1 day").alias("w"))
        .agg(F.count("*").alias("snapshots_observed"))
        .select(
            F.to_date("w.start").alias("dt"),
            "snapshots_observed",
            F.round(F.col("snapshots_observed") / F.lit(float(expected)), 3).alias("coverage_pct"),
        )
    )
