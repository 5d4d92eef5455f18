"""The daily run: gates, staging, marts, checks, publishing, metrics; by day or in full."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from overflight.config import Config
from overflight.functions.timeparts import utc
from overflight.operators import density, metrics, points, quality, staging
from overflight.operators.completeness import freshness_status, incomplete_days
from overflight.sources import ledger
from overflight.sources.bronze import read_bronze
from overflight.sources.reference import literal_table, region_area
from overflight.sources.storage import layer_name, materialize, read_table, replace_days


@dataclass(frozen=True)
class Layout:
    """Where the layers of one environment lie; ``lake`` is the root of bronze, if it is another one."""

    root: str
    env: str = "prod"
    lake: str | None = None

    def run(self, name: str) -> Layout:
        """The same layers in a folder of a run, out of readers' sight."""
        return Layout(f"{self.root.rstrip('/')}/_runs/{name}", self.env, self.lake or self.root)

    def _at(self, layer: str | None, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer_name(self.env, layer, 'source')}/{name}"

    @property
    def bronze(self) -> str:
        # shared by all environments: raw data is collected once
        return f"{(self.lake or self.root).rstrip('/')}/bronze/snapshots"

    @property
    def staging(self) -> str:
        return self._at("staging", "states")

    @property
    def coverage(self) -> str:
        return self._at("intermediate", "daily_coverage")

    @property
    def metrics(self) -> str:
        return self._at("metrics", "quality")

    @property
    def built(self) -> str:
        return self._at("intermediate", "built")

    def mart(self, name: str) -> str:
        return self._at("marts", name)


def gate_results(spark: SparkSession, layout: Layout, cfg: Config, as_of: datetime) -> list[DataFrame]:
    """Source checks that run before any transform: freshness of the last load
    (blocks when too old) and completeness of recent days (never blocks), both
    from the load ledger."""
    loads = ledger.read_ledger(spark, layout.bronze)
    fresh = freshness_status(loads, as_of, cfg.freshness_warn_s, cfg.freshness_error_s).select(
        F.lit("bronze").alias("relation"),
        F.lit("freshness").alias("check_name"),
        F.lit("_loaded_at").alias("column_name"),
        F.lit("error").alias("severity"),
        F.when(F.col("status") == "pass", 0).otherwise(1).cast("bigint").alias("failing_rows"),
        "status",
    )
    few = quality.Singular(
        "daily_completeness",
        lambda: incomplete_days(loads, as_of, cfg.completeness_days, cfg.min_snapshots),
        severity="warn",
    )
    return [fresh, quality.run_singular(few, "bronze")]


def stage_layer(spark: SparkSession, layout: Layout, cfg: Config, days: Sequence[date] | None) -> DataFrame:
    """Parse bronze once and store it by day; every later step reads columns. Raises if a staging check fails."""
    staged = staging.stage(read_bronze(spark, layout.bronze, days), cfg).withColumn("dt", F.to_date("snapshot_time"))
    return _audited_store(staged, "states", layout.staging, days, clustered=True)


def _audited_store(
    df: DataFrame, relation: str, path: str, days: Sequence[date] | None, clustered: bool = False, also: Sequence[str] = ()
) -> DataFrame:
    """Store a layer and look at its declared checks, counted by the write itself; ``also`` names relations that are the same rows."""
    audits = []
    for name in (relation, *also):
        df, audit = quality.audited(df, quality.declared_checks()[name], name)
        audits.append(audit)
    stored = _store(df, path, days, clustered)
    for audit in audits:
        audit.gate()
    return stored


def _store(
    df: DataFrame, path: str, days: Sequence[date] | None, clustered: bool = False, order: Sequence[Column] = ()
) -> DataFrame:
    mode = "table" if days is None else "days"
    stored = materialize(df, path, mode, path=path, days=days, clustered=clustered, order=order)
    return stored if days is None else stored.where(F.col("dt").isin(list(days)))


def mart_layers(
    spark: SparkSession, layout: Layout, cfg: Config, stg: DataFrame, days: Sequence[date] | None, areas: DataFrame
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Coverage and the marts, built from stored staging. All of them are per
    day, so the affected days alone give the same result as a full refresh.
    Raises if a check of a mart fails."""
    coverage = _store(density.daily_coverage(stg, cfg.expected_snapshots), layout.coverage, days)
    region = density.region_density(stg, areas, coverage, sources=cfg.sources)
    grid = density.grid_mart(stg, coverage, cfg.cell_deg, cfg.sources)
    frames = points.aircraft_points(stg, cfg.frame_minutes, cfg.frame_seconds, cfg.sources)
    return coverage, {
        "region_density": _audited_store(region, "region_density", layout.mart("region_density"), days),
        "grid_density": _audited_store(grid, "grid_density", layout.mart("grid_density"), days, also=["grid_counts"]),
        "aircraft_points": _audited_store(
            frames.withColumn("dt", F.to_date("snapshot_time")), "aircraft_points", layout.mart("aircraft_points"), days, clustered=True
        ),
    }


def check_layers(areas: DataFrame, layers: Mapping[str, DataFrame]) -> DataFrame:
    """The result of every declared check on stored layers. The counts behind
    the grid mart are the mart without its coverage."""
    tables = {"region_area": areas, **layers}
    if "grid_density" in layers:
        tables["grid_counts"] = layers["grid_density"].drop("coverage_pct")
    declared = quality.declared_checks()
    return reduce(DataFrame.unionByName, [quality.run_checks(df, declared[name], name) for name, df in tables.items()])


def checked_layers(
    spark: SparkSession, layout: Layout, cfg: Config, days: Sequence[date] | None = None, areas: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Write, audit, publish: the one way in which layers are built, in full or for the days that changed.

    Staging, its checks, marts and their checks all happen in a folder of this
    run, which the next run takes over (a layout has one writer at a time). A
    failing check of severity error stops there, and readers go on seeing what
    they saw. Only then the days of every published layer are replaced, and
    what they were built from is recorded. A run that dies while it publishes
    is repeated as a whole.
    """
    areas = region_area(spark, cfg.regions) if areas is None else areas
    quality.run_gates([check_layers(areas, {})])
    run = layout.run("next")
    # What bronze holds now: a load that lands meanwhile must not pass for built.
    source = materialize(_sources(spark, layout, cfg, areas, days).coalesce(1), "built", "table", path=run.built)
    stg = stage_layer(spark, run, cfg, days)
    coverage, marts = mart_layers(spark, run, cfg, stg, days, areas)
    _store(coverage, layout.coverage, days, clustered=True)
    published = {"states": _store(stg, layout.staging, days, clustered=True)}
    for name, mart in marts.items():
        # neighbouring cells together, so that statistics tell which row groups hold a cell
        order = [density.morton("cell_lon", "cell_lat", cfg.cell_deg)] if name == "grid_density" else []
        published[name] = _store(mart, layout.mart(name), days, clustered=True, order=order)
    sizes = [df.groupBy("dt").agg(F.lit(name).alias("layer"), F.count("*").alias("rows")) for name, df in published.items()]
    record_built(reduce(DataFrame.unionByName, sizes), source, layout, days)
    return published


BUILT_SCHEMA = "layer STRING, rows BIGINT, fingerprint DECIMAL(38,0), recipe STRING, dt DATE"
WHOLE_DAY = "day"


def recipe(cfg: Config, areas: DataFrame) -> DataFrame:
    """One value that changes with the parameters and the areas of a build."""
    rows = F.sort_array(F.collect_list(F.struct("region", "area_sqdeg")))  # one row per region
    return areas.agg(F.sha2(F.concat(F.lit(repr(cfg)), F.to_json(rows)), 256).alias("recipe"))


def _sources(spark: SparkSession, layout: Layout, cfg: Config, areas: DataFrame, days: Sequence[date] | None) -> DataFrame:
    """What bronze holds of these days, from its ledger: ``dt, fingerprint, recipe``."""
    held = ledger.days(ledger.read_ledger(spark, layout.bronze)).select("dt", "fingerprint")
    held = held if days is None else held.where(F.col("dt").isin(list(days)))
    return held.withColumn("recipe", recipe(cfg, areas).scalar())


def record_built(sizes: DataFrame, source: DataFrame, layout: Layout, days: Sequence[date] | None) -> None:
    """Rows per layer and day, and per day what the layers were built from."""
    spark = sizes.sparkSession
    day = source.select(F.lit(WHOLE_DAY).alias("layer"), F.lit(None).cast("bigint").alias("rows"), "fingerprint", "recipe", "dt")
    rows = sizes.select("layer", "rows", F.lit(None).cast("decimal(38,0)").alias("fingerprint"), F.lit(None).cast("string").alias("recipe"), "dt")
    rows = rows.unionByName(day).coalesce(1)
    if days is None:
        rows.write.mode("overwrite").partitionBy("dt").parquet(layout.built)
    else:
        replace_days(rows, layout.built, days, clustered=True)


def read_built(spark: SparkSession, layout: Layout) -> DataFrame:
    return read_table(spark, layout.built, BUILT_SCHEMA)


def built_days(spark: SparkSession, layout: Layout, layer: str) -> DataFrame:
    """``dt, rows`` of a published layer, from the build's own record."""
    return read_built(spark, layout).where(F.col("layer") == layer).select("dt", "rows")


def latest_published(spark: SparkSession, layout: Layout, name: str, schema: str | None = None) -> DataFrame:
    """The newest day of a published mart; its days are known from the record, so files of other days are not opened."""
    mart = spark.read.parquet(layout.mart(name)) if schema is None else read_table(spark, layout.mart(name), schema)
    return mart.where(F.col("dt") == built_days(spark, layout, name).agg(F.max("dt")).scalar())


def changed_days(
    spark: SparkSession, layout: Layout, cfg: Config, days: Sequence[date] | None = None, areas: DataFrame | None = None
) -> DataFrame:
    """``dt, changed``: whether bronze now holds something else than what the layers of a day were built from."""
    areas = region_area(spark, cfg.regions) if areas is None else areas
    now = _sources(spark, layout, cfg, areas, days)
    before = read_built(spark, layout).where(F.col("layer") == WHOLE_DAY).select(
        "dt", F.struct("fingerprint", "recipe").alias("_before"))
    same = F.struct("fingerprint", "recipe").eqNullSafe(F.col("_before"))
    return now.join(before, "dt", "left").select("dt", (~same).alias("changed"))


def rebuild_changed(
    spark: SparkSession, layout: Layout, cfg: Config = Config(), days: Sequence[date] | None = None, areas: DataFrame | None = None
) -> list[date]:
    """Rebuild the layers of those days whose bronze, or whose parameters, changed since they were built.

    A reload that brought what was there before rebuilds nothing. Returns the
    days, one value for each.
    """
    changed = changed_days(spark, layout, cfg, days, areas).where("changed")
    due = sorted(row.dt for row in changed.select("dt").collect())
    if due:
        checked_layers(spark, layout, cfg, due, areas)
    return due


def build(
    spark: SparkSession,
    layout: Layout,
    cfg: Config = Config(),
    days: Sequence[date] | None = None,
    as_of: datetime | None = None,
    areas: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Gates -> staging -> staging checks -> marts -> mart checks -> publishing -> metrics.

    ``days`` limits the run to these days; None rebuilds everything. The gates
    and the metrics look at the tables as of ``as_of``, by default now.
    ``areas`` replaces the areas of the configured boxes, such as a table read
    by ``read_region_area``. A failing check of severity error stops what comes
    after it.
    """
    as_of = as_of or datetime.now(timezone.utc)
    quality.run_gates(gate_results(spark, layout, cfg, as_of))
    layers = checked_layers(spark, layout, cfg, days, areas)
    refresh_metrics(spark, layout, as_of)
    return layers


def refresh_metrics(spark: SparkSession, layout: Layout, as_of: datetime, into: str | None = None) -> bool:
    """Take the metrics and store them with ``query_success`` 1 and the time of
    this success; if they cannot be taken, store ``query_success`` 0 alone and
    carry on. The metrics are a row per day of the window and per region; they
    are taken before the write, whose own failure is not caught. ``into`` names
    another metric table than the layout's.
    """
    try:
        mart = latest_published(spark, layout, "region_density")
        taken = metrics.quality_metrics(ledger.read_ledger(spark, layout.bronze), mart, as_of).collect()
    except Exception:  # any failed query is the event to record
        logging.getLogger(__name__).exception("metrics could not be taken")
        rows = [(metrics.QUERY_SUCCESS, "", 0.0)]
    else:
        rows = [(metrics.QUERY_SUCCESS, "", 1.0), (metrics.LAST_SUCCESS, "", utc(as_of).replace(tzinfo=timezone.utc).timestamp()), *map(tuple, taken)]
    tick = literal_table(spark, rows, "kind STRING, label STRING, value DOUBLE")
    metrics.write_metrics(tick, as_of, into or layout.metrics)
    return len(rows) > 1
