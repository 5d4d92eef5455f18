"""Region density, grid density and daily coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from overflight.config import ADSB
from overflight.functions.geo import snap_to_grid
from overflight.functions.timeparts import day_of


def is_airborne() -> Column:
    """Not on the ground; unknown counts as not airborne."""
    return ~F.col("on_ground")


def is_source(sources: Sequence[int] = (ADSB,)) -> Column:
    return F.col("position_source").isin(list(sources))


def airborne(df: DataFrame) -> DataFrame:
    return df.where(is_airborne())


def adsb_only(df: DataFrame, sources: Sequence[int] = (ADSB,)) -> DataFrame:
    return df.where(is_source(sources))


def located(df: DataFrame) -> DataFrame:
    return df.where(F.col("longitude").isNotNull() & F.col("latitude").isNotNull())


def _coverage_pct(snapshots: Column, expected: int) -> Column:
    return F.round(snapshots / F.lit(float(expected)), 3)


def daily_coverage(stg: DataFrame, expected: int = 144) -> DataFrame:
    """Distinct staged snapshots per UTC day and their share of ``expected``.

    Counts all staged rows, on the ground or not. May exceed 1.
    """
    return (
        stg.groupBy(day_of(stg).alias("dt"))
        .agg(F.countDistinct("snapshot_time").alias("snapshots_observed"))
        .withColumn("coverage_pct", _coverage_pct(F.col("snapshots_observed"), expected))
    )


def with_coverage(df: DataFrame, coverage: DataFrame) -> DataFrame:
    """Add ``coverage_pct`` of the row's day (inner join). Spark picks the join
    by the size it finds."""
    return df.join(coverage.select("dt", "coverage_pct"), "dt")


def snapshot_region_counts(stg: DataFrame, sources: Sequence[int] = (ADSB,), expected: int = 144) -> DataFrame:
    """Airborne count per (snapshot, region) with the day's coverage, in one
    pass over staging.

    The first aggregate combines on the map side and leaves a few rows per
    snapshot. Coverage is read off these rows: the highest dense rank of
    ``snapshot_time`` within a day is its number of distinct snapshots. A day
    has at most 86,400 of them, which bounds the window.
    """
    flying = is_airborne() & is_source(sources)
    counts = stg.groupBy(day_of(stg).alias("dt"), "snapshot_time", "region").agg(
        F.count_if(flying).alias("aircraft_count")
    )
    day = Window.partitionBy("dt")
    rank = F.dense_rank().over(day.orderBy("snapshot_time"))
    return (
        counts.withColumn("_rank", rank)
        .withColumn("coverage_pct", _coverage_pct(F.max("_rank").over(day), expected))
        .drop("_rank")
    )


def coverage_parts(stg: DataFrame, *by: str) -> DataFrame:
    """Snapshot times of a day as bitmaps over its seconds: ``dt, bucket, bitmap`` (and the columns ``by``).

    A bucket holds 32,768 seconds in 4 KB, so a day has at most three rows of
    bounded size. Bitmaps of parts (regions, late files, hours) are merged
    without looking at the rows again, and their union counts exactly.
    """
    second = F.unix_seconds("snapshot_time") % 86_400
    return stg.groupBy(
        F.to_date("snapshot_time").alias("dt"), *by, F.bitmap_bucket_number(second).alias("bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position(second)).alias("bitmap"))


def merged_parts(parts: DataFrame) -> DataFrame:
    """Bitmaps of any number of parts as those of the whole."""
    return parts.groupBy("dt", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def coverage_of_parts(parts: DataFrame, expected: int = 144) -> DataFrame:
    """The same as ``daily_coverage`` of the rows behind the parts."""
    seen = merged_parts(parts).groupBy("dt").agg(F.sum(F.bitmap_count("bitmap")).alias("snapshots_observed"))
    share = F.col("snapshots_observed") / F.lit(float(expected))
    return seen.select("dt", "snapshots_observed", F.round(share, 3).alias("coverage_pct"))


def region_density(
    stg: DataFrame,
    areas: DataFrame,
    coverage: DataFrame | None = None,
    *,
    sources: Sequence[int] = (ADSB,),
    expected: int = 144,
    fill_zero: bool = False,
) -> DataFrame:
    """Airborne aircraft per square degree, per snapshot and region of ``areas``.

    Counts are aggregated before ``areas`` is joined; that join also drops the
    background, which has no area. Spark broadcasts ``areas`` by its known
    size. ``coverage`` may come from a stored table, else it is taken from the
    same pass. Snapshots without aircraft in a region give no row unless
    ``fill_zero`` is set.
    """
    counts = snapshot_region_counts(stg, sources, expected)
    if fill_zero:
        counts = _every_region(counts, areas)
    else:
        counts = counts.where(F.col("aircraft_count") > 0)
    if coverage is not None:
        counts = with_coverage(counts.drop("coverage_pct"), coverage)
    return counts.join(areas, "region").select(
        "dt",
        "snapshot_time",
        "region",
        "aircraft_count",
        "area_sqdeg",
        F.round(F.col("aircraft_count") / F.col("area_sqdeg"), 4).alias("density"),
        "coverage_pct",
    )


def _every_region(counts: DataFrame, areas: DataFrame) -> DataFrame:
    """One row per staged snapshot and region of ``areas``, zeros included."""
    known = counts.groupBy("dt", "snapshot_time", "coverage_pct").agg(
        F.map_from_entries(F.collect_list(F.struct("region", "aircraft_count"))).alias("known")
    )
    regions = areas.agg(F.sort_array(F.collect_set("region"))).scalar()
    spread = known.withColumn("regions", regions).withColumn("region", F.explode("regions"))
    count = F.coalesce(F.col("known")[F.col("region")], F.lit(0)).cast("bigint")
    return spread.select("dt", "snapshot_time", "region", count.alias("aircraft_count"), "coverage_pct")


def grid_density(stg: DataFrame, cell_deg: float = 0.5, sources: Sequence[int] = (ADSB,)) -> DataFrame:
    """Airborne rows per (day, region, cell). Cells are equal, so the count is
    the density."""
    return (
        adsb_only(airborne(located(stg)), sources)
        .groupBy(
            day_of(stg).alias("dt"),
            "region",
            snap_to_grid("longitude", cell_deg).alias("cell_lon"),
            snap_to_grid("latitude", cell_deg).alias("cell_lat"),
        )
        .agg(F.count("*").alias("aircraft_count"))
    )


def grid_mart(stg: DataFrame, coverage: DataFrame, cell_deg: float = 0.5, sources: Sequence[int] = (ADSB,)) -> DataFrame:
    """Grid density with the coverage of its day."""
    return with_coverage(grid_density(stg, cell_deg, sources), coverage).select(
        "dt", "region", "cell_lon", "cell_lat", "aircraft_count", "coverage_pct"
    )


def latest_day(df: DataFrame, day: str = "dt") -> DataFrame:
    """Rows of the most recent day. On a table partitioned by ``day`` the
    scalar subquery prunes the scan to one partition."""
    return df.where(F.col(day) == df.agg(F.max(day)).scalar())


def _spread(number: Column) -> Column:
    """The low 16 bits of a number, every second bit free. The masks are those of interleaving by doubling."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        number = F.shiftleft(number, shift).bitwiseOR(number).bitwiseAND(F.lit(mask))
    return number


def morton(cell_lon: Column | str, cell_lat: Column | str, cell_deg: float = 0.5) -> Column:
    """Number of a cell on a curve that keeps neighbouring cells together."""
    column = lambda c: F.col(c) if isinstance(c, str) else c
    step = lambda degrees, offset: F.floor((column(degrees) + F.lit(offset)) / F.lit(cell_deg)).cast("bigint").bitwiseAND(F.lit(0xFFFF))
    return _spread(step(cell_lon, 180.0)).bitwiseOR(F.shiftleft(_spread(step(cell_lat, 90.0)), 1))


def grid_latest(grid: DataFrame) -> DataFrame:
    return latest_day(grid)


def grid_trend(
    grid: DataFrame, region: str | None = None, cell: tuple[float, float] | None = None
) -> DataFrame:
    """The grid over days, for one region or cell, ordered by day. Of a grid
    stored in the order of ``morton`` a cell's trend reads the few row groups
    whose statistics admit the cell.
    """
    if region is not None:
        grid = grid.where(F.col("region") == region)
    if cell is not None:
        grid = grid.where((F.col("cell_lon") == F.lit(float(cell[0]))) & (F.col("cell_lat") == F.lit(float(cell[1]))))
    return grid.orderBy("dt", "region", "cell_lon", "cell_lat")


def density_contrast(mart: DataFrame, baseline: str = "west_europe") -> DataFrame:
    """Mean density per region and how many times lower than ``baseline``.

    The window spans the aggregated rows, one per region.
    """
    means = mart.groupBy("region").agg(F.round(F.avg("density"), 6).alias("mean_density"))
    base = F.max(F.when(F.col("region") == baseline, F.col("mean_density"))).over(Window.partitionBy(F.lit(0)))
    return means.withColumn("times_lower", F.round(base / F.nullif("mean_density", F.lit(0.0)), 1))
