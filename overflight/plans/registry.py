"""The named queries: each runs operators over whole input tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone
from dataclasses import replace
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from overflight.config import REGIONS, Box, Config
from overflight.functions import status, timeparts
from overflight.operators import alerts, boxes, completeness, density, metrics, points, profile, quality, staging
from overflight.plans import pipeline
from overflight.plans.events import REGION, bronze_from_events, hourly_series, raw_documents, read_events, read_table
from overflight.session import configure, scratch_path
from overflight.sources import bronze as bronze_source, ledger, raw as raw_source
from overflight.sources.reference import box_table, literal_table, read_region_area, region_area
from overflight.sources.storage import materialize, write_days
from overflight.streaming import aggregates, alert_jobs, arrivals, runs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CFG = Config()
AS_OF = datetime(2024, 1, 31, 12, 0)  # the events end on 2024-01-30
LAST_DAY = date(2024, 1, 30)

# Rules for the hourly series of the events.
RULES = (
    alerts.Rule("bronze_stale", "freshness", ">", 100000, hold_s=3600, severity="critical"),
    alerts.Rule("metrics_query_failed", "query_success", "==", 0, hold_s=3600),
    alerts.Rule("low_coverage", "coverage", "<", 0.3, hold_s=7200, over_labels=True),
    alerts.Rule("high_density", "density", ">=", 50, hold_s=3600),
    alerts.Rule("other_team", "density", ">=", 60, hold_s=0, team="someone-else"),
)


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain_times(fn(configure(spark), sf_dir))

    QUERIES[fn.__name__] = run
    return fn


def _plain_times(df: DataFrame) -> DataFrame:
    """Instants leave as wall-clock UTC, the form the input tables have, and
    days as ISO text."""
    plain = {T.TimestampType: "timestamp_ntz", T.DateType: "string"}
    return df.select(*[
        F.col(f.name).cast(plain[type(f.dataType)]).alias(f.name) if type(f.dataType) in plain else F.col(f.name)
        for f in df.schema.fields
    ])


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage(bronze_from_events(spark, sf_dir), CFG)


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several parts of a query read, so that it is
    computed once; by day if it has one."""
    return materialize(df, name, "table", path=scratch_path(df.sparkSession, name))


def _stored_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(_staged(spark, sf_dir).withColumn("dt", F.to_date("snapshot_time")), "states")


def _stored_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(bronze_from_events(spark, sf_dir), "bronze")


def _density(spark: SparkSession, stg: DataFrame, **options) -> DataFrame:
    return density.region_density(stg, region_area(spark), expected=CFG.expected_snapshots, **options)


def _lake(spark: SparkSession, bronze: DataFrame, name: str = "lake") -> pipeline.Layout:
    """A new lake that holds these bronze rows and their ledger."""
    layout = pipeline.Layout(scratch_path(spark, name))
    write_days(bronze, layout.bronze)
    bronze_source.note_load(spark, layout.bronze)
    return layout


def _stored_mart(spark: SparkSession, bronze: DataFrame) -> DataFrame:
    return _stored(_density(spark, staging.stage(bronze, CFG)), "region_density")


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_series(read_events(spark, sf_dir))


# --- staging and marts -------------------------------------------------------


@query
def stage_states(spark, sf_dir):
    return _staged(spark, sf_dir).withColumn("sensors", F.array_join("sensors", ","))


@query
def snapshot_sizes(spark, sf_dir):
    bronze = bronze_from_events(spark, sf_dir)
    return bronze.groupBy("snapshot_time", "region").agg(F.sum(staging.state_count("raw")).cast("bigint").alias("aircraft"))


@query
def cast_quarantine(spark, sf_dir):
    """Vectors whose track is no whole number, read as if it had to be one."""
    vectors = staging.explode_states(bronze_from_events(spark, sf_dir))
    odd = vectors.withColumn("vector", F.transform("vector", lambda text, i: F.when(
        (i == 4) & (F.get("vector", F.lit(16)) == "3"), F.get("vector", F.lit(10))).otherwise(text)))
    failed = staging.cast_failures(odd)
    return failed.groupBy("snapshot_time", F.array_join("failed_fields", ",").alias("failed_fields")).agg(
        F.count("*").alias("vectors")
    )


@query
def daily_coverage(spark, sf_dir):
    return density.daily_coverage(_staged(spark, sf_dir), CFG.expected_snapshots)


@query
def coverage_merged(spark, sf_dir):
    """Daily coverage from bitmaps of parts: by region and by whether an event came late. Parts overlap in the
    snapshots they saw."""
    stg = _staged(spark, sf_dir).withColumn("late", F.xxhash64("icao24") % 3 == 0)
    parts = _stored(density.coverage_parts(stg, "region", "late"), "coverage-parts")
    return density.coverage_of_parts(parts, CFG.expected_snapshots)


@query
def region_density(spark, sf_dir):
    return _density(spark, _staged(spark, sf_dir)).drop("dt")


@query
def region_density_zero_filled(spark, sf_dir):
    return _density(spark, _staged(spark, sf_dir), fill_zero=True).drop("dt")


@query
def grid_density(spark, sf_dir):
    return density.grid_density(_staged(spark, sf_dir), CFG.cell_deg)


@query
def grid_density_quarter(spark, sf_dir):
    return density.grid_density(_staged(spark, sf_dir), 0.25)


def _grid_mart(spark, sf_dir):
    stg = _stored_staging(spark, sf_dir)
    return density.grid_mart(stg, density.daily_coverage(stg, CFG.expected_snapshots), CFG.cell_deg)


@query
def grid_mart(spark, sf_dir):
    return _grid_mart(spark, sf_dir)


@query
def grid_latest(spark, sf_dir):
    """The newest day of the published grid, known from the record of the build."""
    layout = _lake(spark, bronze_from_events(spark, sf_dir))
    pipeline.checked_layers(spark, layout, CFG)
    return pipeline.latest_published(spark, layout, "grid_density")


@query
def grid_trend(spark, sf_dir):
    return density.grid_trend(_grid_mart(spark, sf_dir), region="ukraine")


@query
def grid_cell_trend(spark, sf_dir):
    """The fullest cell over all days, from a published grid in the order of the curve."""
    layout = _lake(spark, bronze_from_events(spark, sf_dir))
    grid = pipeline.checked_layers(spark, layout, CFG)["grid_density"]
    sizes = grid.groupBy("cell_lon", "cell_lat").agg(F.sum("aircraft_count").alias("n"))
    fullest = sizes.agg(F.max(F.struct("n", "cell_lon", "cell_lat")).alias("top")).select("top.*").first()
    return density.grid_trend(grid, cell=(fullest.cell_lon, fullest.cell_lat))


@query
def aircraft_points(spark, sf_dir):
    return points.aircraft_points(_staged(spark, sf_dir))


@query
def aircraft_points_first_frame(spark, sf_dir):
    return points.aircraft_points(_stored_staging(spark, sf_dir), first_per_bucket=True)


@query
def points_export(spark, sf_dir):
    """The export reads the stored mart."""
    out, mart = scratch_path(spark, "export"), points.aircraft_points(_staged(spark, sf_dir))
    points.export_points(_stored(mart.withColumn("dt", F.to_date("snapshot_time")), "points"), AS_OF, out, CFG.map_days)
    return spark.read.parquet(out)


@query
def playback_window(spark, sf_dir):
    pts = points.aircraft_points(_staged(spark, sf_dir)).withColumn("dt", F.to_date("snapshot_time"))
    return points.playback_window(_stored(pts, "points"), timedelta(hours=1)).drop("dt")


@query
def density_contrast(spark, sf_dir):
    return density.density_contrast(_density(spark, _staged(spark, sf_dir)), CFG.baseline)


@query
def source_profile(spark, sf_dir):
    return profile.source_profile(_stored_staging(spark, sf_dir))


@query
def source_first_seen(spark, sf_dir):
    return profile.source_first_seen(_staged(spark, sf_dir))


@query
def region_density_boxes(spark, sf_dir):
    """Density in boxes whose sides are no whole degrees."""
    own = (Box("north", 2.5, 14.25, 45.5, 52.75), Box("south", 10.0, 40.5, 30.25, 46.5))
    stg = boxes.assign_box(_staged(spark, sf_dir).drop("region"), box_table(spark, own))
    return density.region_density(stg, region_area(spark, own), expected=CFG.expected_snapshots).drop("dt")


# --- boxes -------------------------------------------------------------------


@query
def assign_box(spark, sf_dir):
    """Line items placed into overlapping boxes over quantity and discount."""
    areas = literal_table(
        spark,
        [
            ("small", 1, 1.0, 10.0, 0.0, 0.03),
            ("middle", 2, 8.0, 30.0, 0.02, 0.07),
            ("deep", 3, 1.0, 50.0, 0.06, 0.1),
        ],
        "region STRING, priority INT, lomin DOUBLE, lomax DOUBLE, lamin DOUBLE, lamax DOUBLE",
    )
    items = read_table(spark, sf_dir, "lineitem").select("l_quantity", "l_discount", "l_extendedprice")
    placed = boxes.assign_box(items, areas, "l_quantity", "l_discount", cell=(10.0, 0.05))
    return placed.groupBy("region").agg(
        F.count("*").alias("items"), F.round(F.sum("l_extendedprice"), 2).alias("price")
    )


@query
def assign_box_states(spark, sf_dir):
    """The region of every position from the box table instead of the rule."""
    stg = _staged(spark, sf_dir).select("snapshot_time", "icao24", "longitude", "latitude")
    return boxes.assign_box(stg, box_table(spark, REGIONS))


@query
def assign_box_sizes(spark, sf_dir):
    """Every position among as many boxes as there are users, with sides from 0.05 to 205 degrees, and the
    whole world. Returns the index rows a box takes at most, with the positions per box."""
    side = F.lit(0.05) * F.pow(F.lit(2.0), F.col("user_id") % 13)
    own = read_events(spark, sf_dir).select("user_id").distinct().select(
        F.concat(F.lit("box "), F.col("user_id").cast("string")).alias("region"), (F.col("user_id") + 1).cast("int").alias("priority"),
        (F.lit(-20.0) + (F.col("user_id") * 7919 % 10000) / F.lit(100.0)).alias("lomin"),
        (F.lit(10.0) + (F.col("user_id") * 104729 % 5500) / F.lit(100.0)).alias("lamin"), side.alias("side"))
    own = own.select("region", "priority", "lomin", (F.col("lomin") + F.col("side")).alias("lomax"), "lamin",
                     (F.col("lamin") + F.col("side")).alias("lamax"))
    world = literal_table(spark, [("world", 2_000_000_000, -180.0, 180.0, -90.0, 90.0)],
                          "region STRING, priority INT, lomin DOUBLE, lomax DOUBLE, lamin DOUBLE, lamax DOUBLE")
    areas = _stored(own.unionByName(world), "boxes")
    cell = (0.1, 0.1)
    most = boxes.box_index(areas, cell).groupBy("region").count().agg(F.max("count").alias("most"))
    lists = _stored(boxes.box_lists(areas, cell), "box-lists")
    stg = _staged(spark, sf_dir).select("longitude", "latitude")
    placed = boxes.assign_box(stg, areas, cell=cell, lists=lists).groupBy("region").agg(F.count("*").alias("positions"))
    return placed.withColumn("bounded", most.scalar() <= 4)


@query
def credit_budget(spark, sf_dir):
    extents = boxes.observed_extents(_staged(spark, sf_dir))
    return boxes.credit_budget(extents).withColumn("area_sqdeg", F.round("area_sqdeg", 4))


@query
def region_geojson(spark, sf_dir):
    return boxes.region_geojson(boxes.observed_extents(_staged(spark, sf_dir)))


# --- completeness, metrics, checks -------------------------------------------


@query
def incomplete_days(spark, sf_dir):
    return completeness.incomplete_days(bronze_from_events(spark, sf_dir), AS_OF, days=30, threshold=130)


@query
def completeness_message(spark, sf_dir):
    few = completeness.incomplete_days(bronze_from_events(spark, sf_dir), AS_OF, days=30, threshold=130)
    return completeness.completeness_message(few, 130)


@query
def missing_days(spark, sf_dir):
    return completeness.missing_days(bronze_from_events(spark, sf_dir), AS_OF + timedelta(days=3), days=7)


@query
def daily_health(spark, sf_dir):
    return completeness.daily_health(bronze_from_events(spark, sf_dir), datetime(2024, 1, 30, 18), days=7, expected=135)


@query
def mart_freshness(spark, sf_dir):
    mart = _stored_mart(spark, bronze_from_events(spark, sf_dir))
    seoul = timezone(timedelta(hours=9))
    moments = (AS_OF, datetime(2024, 2, 1, 0, 30), datetime(2024, 2, 1, 1, 30), datetime(2024, 2, 1, 9, 45, tzinfo=seoul))
    checked = [
        completeness.mart_freshness(mart, at, CFG.mart_ready_minute).withColumn("as_of", timeparts.instant(at))
        for at in moments
    ]
    return reduce(DataFrame.unionByName, checked)


@query
def freshness_status(spark, sf_dir):
    """From the load ledger alone."""
    layout = _lake(spark, bronze_from_events(spark, sf_dir))
    loads = ledger.read_ledger(spark, layout.bronze)
    newest = datetime(2024, 1, 31)
    ages = (timedelta(hours=36), timedelta(hours=36, seconds=1), timedelta(hours=48, seconds=1))
    checked = [
        completeness.freshness_status(loads, newest + age, CFG.freshness_warn_s, CFG.freshness_error_s) for age in ages
    ]
    shown = status.status_steps("age_seconds", status.FRESHNESS_STEPS)
    return reduce(DataFrame.unionByName, checked).withColumn("panel", shown)


@query
def health_verdict(spark, sf_dir):
    bronze = _stored_bronze(spark, sf_dir)
    checks = completeness.health_checks(bronze, _stored_mart(spark, bronze), AS_OF, days=7, expected=120)
    return completeness.health_verdict(checks)


@query
def quality_metrics(spark, sf_dir):
    bronze = _stored_bronze(spark, sf_dir)
    taken = metrics.quality_metrics(bronze, _stored_mart(spark, bronze), AS_OF)
    return taken.withColumn("value", F.round("value", 6))


@query
def metric_panels(spark, sf_dir):
    """Status colours and labels over the stored metrics of one refresh."""
    layout = pipeline.Layout(scratch_path(spark, "panels"))
    bronze = _stored_bronze(spark, sf_dir)
    mart = _stored_mart(spark, bronze)
    taken = metrics.quality_metrics(bronze, mart, AS_OF).unionByName(
        literal_table(spark, [("query_success", "", 1.0)], "kind STRING, label STRING, value DOUBLE")
    )
    metrics.write_metrics(taken, AS_OF, layout.metrics)
    current = metrics.read_current(spark, layout.metrics)
    kind = F.col("metric")
    shown = (
        F.when(kind == "freshness", status.status_steps("value", status.FRESHNESS_STEPS))
        .when(kind == "coverage", status.status_steps("value", status.COVERAGE_STEPS))
        .when(kind == "snapshot", status.status_steps("value", status.SNAPSHOT_STEPS))
        .when(kind == "query_success", status.map_values("value", status.SUCCESS_LABELS))
    )
    return current.select("ts", "metric", "label", F.round("value", 6).alias("value"), shown.alias("status"))


@query
def metric_refresh(spark, sf_dir):
    """The metric table after a day of its refresh job (two triggers) and a
    day later, when two refreshes, one of them repeated, are followed by one
    that fails for want of a mart: the last good values stay. What the first
    day left is folded before."""
    layout = _lake(spark, bronze_from_events(spark, sf_dir))
    pipeline.checked_layers(spark, layout, CFG)
    pace, times = timedelta(minutes=5), [AS_OF - timedelta(days=1, minutes=5), AS_OF - timedelta(days=1)]

    def clock():
        return times.pop(0)  # no third time: the job ends there

    job = alert_jobs.metrics(spark, layout, every="1 second", clock=clock).option("checkpointLocation", scratch_path(spark, "checkpoint"))
    try:
        job.start().awaitTermination()
    except StreamingQueryException:
        pass
    metrics.fold_history(spark, layout.metrics, AS_OF.date())
    for tick in (AS_OF, AS_OF + pace, AS_OF + pace):
        pipeline.refresh_metrics(spark, layout, tick)
    without = replace(layout, env="trial")  # no marts there
    pipeline.refresh_metrics(spark, without, AS_OF + 2 * pace, into=layout.metrics)
    ticks = metrics.read_history(spark, layout.metrics).agg(F.count_distinct("ts").alias("ticks"))
    current = metrics.read_current(spark, layout.metrics).withColumn("value", F.round("value", 6))
    return current.withColumn("ticks", ticks.select("ticks").scalar())


@query
def metric_minimum(spark, sf_dir):
    return metrics.metric_min(_series(spark, sf_dir))


@query
def last_not_null(spark, sf_dir):
    events = read_events(spark, sf_dir)
    series = events.select(
        "ts",
        F.col("event_type").alias("metric"),
        F.col("user_id").cast("string").alias("label"),
        F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("value"),
    )
    return metrics.last_not_null(series)


@query
def recent_series(spark, sf_dir):
    recent = metrics.recent_series(_series(spark, sf_dir), "density", AS_OF, timedelta(hours=24))
    return recent.withColumn("value", F.round("value", 6))


@query
def dq_results(spark, sf_dir):
    """Declared staging checks, and checks that do fail on the given tables."""
    stg = _staged(spark, sf_dir)
    own = [
        quality.accepted_range("true_track", 0, 360, severity="warn"),
        quality.not_null("callsign", severity="warn"),
        quality.not_null("squawk", where="not on_ground"),
        quality.accepted_values("region", ["ukraine", "other"]),
        quality.accepted_range("velocity", None, 150.0, where="region != 'other'"),
    ]
    items = [
        quality.accepted_range("l_discount", 0.0, 0.05),
        quality.accepted_values("l_returnflag", ["A", "N"]),
        quality.not_null("l_shipdate"),
        quality.accepted_range("l_quantity", 5, None, where="l_linestatus = 'O'"),
    ]
    orders = [
        quality.unique("o_orderkey"),
        quality.unique("o_custkey"),
        quality.accepted_values("o_orderstatus", ["F", "O", "P"]),
    ]
    parts = [
        quality.run_checks(stg, quality.declared_checks()["states"] + own, "states"),
        quality.run_checks(read_table(spark, sf_dir, "lineitem"), items, "lineitem"),
        quality.run_checks(read_table(spark, sf_dir, "orders"), orders, "orders"),
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def dq_singular(spark, sf_dir):
    """Bronze completeness as a check that warns and never blocks."""
    bronze = bronze_from_events(spark, sf_dir)
    few = quality.Singular(
        "daily_completeness", lambda: completeness.incomplete_days(bronze, AS_OF, 30, 130), severity="warn"
    )
    return quality.run_singular(few, "bronze")


# --- alerts ------------------------------------------------------------------


def _states(spark, sf_dir):
    """The rules look at the stored series, as they would at the metric table."""
    return alerts.evaluate_alerts(_stored(_series(spark, sf_dir), "series"), alerts.rule_table(spark, RULES))


def _timeline(states):
    return states.select("alert", "instance", "ts", "value", "state", "active_since", "severity")


@query
def alert_timeline(spark, sf_dir):
    return _timeline(_states(spark, sf_dir))


@query
def alert_notifications(spark, sf_dir):
    """What one team is told: starts and ends of firing."""
    told = alerts.state_changes(alerts.routed(_states(spark, sf_dir), "overflight"))
    return told.select("alert", "instance", "severity", "state", "ts", "active_since", "title")


@query
def declared_rules(spark, sf_dir):
    """The declared rules on the stored series, with the text of each change."""
    series = _stored(_series(spark, sf_dir), "series")
    told = alerts.state_changes(alerts.evaluate_alerts(series, alerts.rule_table(spark)))
    return told.select("alert", "instance", "state", "ts", "title", "text")


@query
def heartbeat_gaps(spark, sf_dir):
    return alerts.heartbeat(read_events(spark, sf_dir), ["user_id"], silent_s=6 * 3600, as_of=AS_OF)


@query
def classify_failures(spark, sf_dir):
    kind = F.col("event_type")
    failures = read_events(spark, sf_dir).select(
        "event_id",
        F.when(kind == "error", "bronze_snapshots.source")
        .when(kind == "click", "bronze_snapshots.test")
        .when(kind == "signup", "marts.region_density.source")
        .otherwise("load_days").alias("task_id"),
        F.expr("repeat(props, cast(1 + event_id % 100 as int))").alias("error"),
    )
    return alerts.classify_failures(failures, "bronze_snapshots")


# --- storage -----------------------------------------------------------------


@query
def partition_replace(spark, sf_dir):
    """All orders by month; months with urgent orders of 1996 on are then
    replaced by these orders at double price, and nothing else changes."""
    path = scratch_path(spark, "orders")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderpriority", F.to_date(F.date_trunc("month", "o_orderdate")).alias("dt")
    )
    write_days(orders, path)
    urgent = orders.where((F.col("o_orderpriority") == "1-URGENT") & (F.year("dt") >= 1996))
    doubled = urgent.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    write_days(doubled, path)
    write_days(orders.where(F.col("o_orderkey") < 0), path)  # nothing to load, nothing changes
    stored = spark.read.parquet(path)
    return stored.groupBy("dt").agg(
        F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("price")
    )


@query
def backfill(spark, sf_dir):
    """Raw files of three regions on disk, two of them loaded over the whole
    date range and then again."""
    root, table = scratch_path(spark, "raw"), scratch_path(spark, "bronze")
    events = read_events(spark, sf_dir)
    documents = raw_documents(events)
    others = [documents.withColumn("region", F.lit(name)) for name in ("korea", "left out")]
    raw_source.land_raw(reduce(DataFrame.unionByName, others, documents), root)
    raw_source.land_raw(documents, root)  # the same snapshots land again
    first, last = events.agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    for _ in range(2):
        bronze_source.backfill(spark, root, table, first, last, regions=[REGION, "korea"], pattern="*.txt", packed=True)
    return _loaded(bronze_source.read_bronze(spark, table), "region")


def _loaded(bronze: DataFrame, *by: str) -> DataFrame:
    return bronze.groupBy("dt", *by).agg(
        F.countDistinct("region", "snapshot_time").alias("snapshots"),
        F.sum(staging.state_count("raw")).cast("bigint").alias("vectors"),
    )


@query
def load_quarantine(spark, sf_dir):
    """Documents of which some are glued together and some cut short: what a
    tolerant load takes and what it sets aside."""
    documents = raw_documents(read_events(spark, sf_dir))
    number = F.floor(F.get_json_object("value", "$.time").cast("bigint") / 600)
    value = F.col("value")
    spoilt = documents.withColumn("value", F.when(number % 5 == 0, F.concat(value, value)).when(
        number % 7 == 0, F.substring(value, F.lit(1), F.length(value) - 2)).otherwise(value))
    loaded = bronze_source.to_bronze(spoilt, mode="PERMISSIVE").select("snapshot_time").distinct()
    aside = bronze_source.quarantine(spoilt).select(F.regexp_extract("value", '"time":([0-9]+)', 1).alias("time")).distinct()
    count = lambda df, name: df.agg(F.lit(name).alias("outcome"), F.count("*").alias("snapshots"))
    return count(loaded, "loaded").unionByName(count(aside, "quarantined"))


@query
def ingest_status(spark, sf_dir):
    """The landed raw files of every day and of the day after the last one, as a listing. File
    times and sizes vary from run to run; whether there are any, and the verdict, do not."""
    root = scratch_path(spark, "raw")
    events = read_events(spark, sf_dir)
    raw_source.land_raw(raw_documents(events), root)
    first, last = events.agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    listed = [
        raw_source.ingest_status(spark, root, datetime.combine(day, datetime.min.time()), pattern="*.txt").select(
            F.lit(day).alias("dt"), (F.col("files") > 0).alias("has_files"),
            (F.coalesce("bytes", F.lit(0)) > 0).alias("has_bytes"), F.col("newest").isNotNull().alias("has_newest"), "status")
        for day in (first + timedelta(days=n) for n in range((last - first).days + 2))
    ]
    return reduce(DataFrame.unionByName, listed)


@query
def daily_build(spark, sf_dir):
    """Full build, then a rebuild of three days; rows and checks per mart."""
    layout = _lake(spark, bronze_from_events(spark, sf_dir))
    pipeline.build(spark, layout, CFG, as_of=AS_OF)
    built = pipeline.build(spark, layout, CFG, days=[date(2024, 1, d) for d in (3, 4, 30)], as_of=AS_OF)
    tables = {name: spark.read.parquet(layout.mart(name)) for name in built if name != "states"}
    checks = pipeline.check_layers(region_area(spark), tables)
    failing = checks.groupBy("relation").agg(F.sum("failing_rows").alias("failing_rows"))
    sizes = reduce(
        DataFrame.unionByName,
        [
            df.agg(F.lit(n).alias("relation"), F.count("*").alias("rows"), F.countDistinct("dt").alias("days"))
            for n, df in tables.items()
        ],
    )
    return sizes.join(failing, "relation")


@query
def build_checks(spark, sf_dir):
    """All declared checks on layers built with the areas of a reference file."""
    layout, seed = _lake(spark, bronze_from_events(spark, sf_dir)), scratch_path(spark, "areas")
    region_area(spark).coalesce(1).write.option("header", True).csv(seed)
    areas = read_region_area(spark, seed)
    layers = pipeline.build(spark, layout, CFG, as_of=AS_OF, areas=areas)
    return pipeline.check_layers(areas, layers)


@query
def publish_after_audit(spark, sf_dir):
    """What readers see of two days of the region mart. Both are loaded again
    with half of their vectors: first with velocities that a check rejects,
    which must leave the published mart as it is, then with sound ones."""
    layout = _lake(spark, bronze_from_events(spark, sf_dir))
    days = [date(2024, 1, 3), date(2024, 1, 4)]
    pipeline.checked_layers(spark, layout, CFG)
    half = read_events(spark, sf_dir).where((F.col("event_id") % 2 == 0) & F.to_date("ts").isin(days))
    seen = []
    for name, value in (("rejected", F.lit(-1.0)), ("sound", F.col("value"))):
        bronze = bronze_source.to_bronze(raw_documents(half.withColumn("value", value)), AS_OF)
        write_days(bronze, layout.bronze)
        bronze_source.note_load(spark, layout.bronze, days)
        try:
            rebuilt = len(pipeline.rebuild_changed(spark, layout, CFG, days))
        except quality.GateError:
            rebuilt = 0
        mart = spark.read.parquet(layout.mart("region_density")).groupBy("dt").agg(
            F.count("*").alias("rows"), F.sum("aircraft_count").alias("aircraft"))
        seen.append(_stored(mart.select("*", F.lit(name).alias("load"), F.lit(rebuilt).cast("bigint").alias("rebuilt")), name))
    return reduce(DataFrame.unionByName, seen)


# --- streams -----------------------------------------------------------------


def _stream_staged(spark, sf_dir):
    table = scratch_path(spark, "bronze")
    write_days(bronze_from_events(spark, sf_dir), table)
    return staging.stage(arrivals.stream_bronze(spark, table), CFG)


DENSITY_UPDATES = "snapshot_time TIMESTAMP, region STRING, aircraft_count BIGINT, area_sqdeg DOUBLE, density DOUBLE"


@query
def stream_region_density(spark, sf_dir):
    counted = aggregates.region_density(_stream_staged(spark, sf_dir), region_area(spark))
    out = scratch_path(spark, "updates")
    writer = counted.writeStream.outputMode("update").foreachBatch(runs.write_batch(out))
    arrivals.run_available(writer, scratch_path(spark, "checkpoint"))
    return runs.read_latest(spark, out, ["snapshot_time", "region"], DENSITY_UPDATES)


@query
def stream_density_folded(spark, sf_dir):
    """Continuous density of days that come one half after the other; the updates of the first half are folded
    into one row per key before the second, and readers start from there."""
    bronze, table = _stored_bronze(spark, sf_dir), scratch_path(spark, "bronze")
    out, checkpoint = scratch_path(spark, "updates"), scratch_path(spark, "checkpoint")
    keys = ["snapshot_time", "region"]
    early = F.dayofmonth("dt") <= 15
    for half, fold in ((early, True), (~early, False)):
        write_days(bronze.where(half), table)
        counted = aggregates.region_density(staging.stage(arrivals.stream_bronze(spark, table), CFG), region_area(spark))
        arrivals.run_available(counted.writeStream.outputMode("update").foreachBatch(runs.write_batch(out)), checkpoint)
        if fold:
            runs.fold(spark, out, keys, DENSITY_UPDATES)
    return runs.read_latest(spark, out, keys, DENSITY_UPDATES)


@query
def stream_frames(spark, sf_dir):
    counted = aggregates.frames(_stream_staged(spark, sf_dir))
    out = scratch_path(spark, "updates")
    writer = counted.writeStream.outputMode("update").foreachBatch(runs.write_batch(out))
    arrivals.run_available(writer, scratch_path(spark, "checkpoint"))
    return runs.read_latest(spark, out, ["frame", "region"], "frame TIMESTAMP, region STRING, aircraft_count BIGINT")


@query
def stream_coverage(spark, sf_dir):
    """Days the watermark has closed."""
    closed = aggregates.coverage(_stream_staged(spark, sf_dir), expected=CFG.expected_snapshots)
    out = scratch_path(spark, "coverage")
    writer = closed.writeStream.outputMode("append").format("parquet").option("path", out)
    arrivals.run_available(writer, scratch_path(spark, "checkpoint"))
    return spark.read.schema(closed.schema).parquet(out)


@query
def stream_ingest(spark, sf_dir):
    """Raw files as they land. Every snapshot lands first with some of its
    vectors and then in full; the later copy counts."""
    root, out, checkpoint = scratch_path(spark, "raw"), scratch_path(spark, "bronze"), scratch_path(spark, "checkpoint")
    events = read_events(spark, sf_dir)
    for part in (events.where("event_id % 3 <> 0"), events):
        raw_source.land_raw(raw_documents(part), root)
        arrivals.ingest(spark, root, out, checkpoint, pattern="*.txt", packed=True)
    return _loaded(bronze_source.read_bronze(spark, out))


@query
def reload_changed(spark, sf_dir):
    """Which days a second load brought in again, and which of these were
    rebuilt. Every third day first lands without a quarter of its vectors, then
    every second day lands again in full: only every sixth day has changed."""
    layout = pipeline.Layout(scratch_path(spark, "lake"))
    root, checkpoint = scratch_path(spark, "raw"), scratch_path(spark, "checkpoint")
    events = read_events(spark, sf_dir)
    documents = _stored(raw_documents(events), "documents")  # the second copy says the same word for word
    day = F.dayofmonth(F.timestamp_seconds(F.get_json_object("value", "$.time").cast("bigint")))
    short = raw_documents(events.where((F.dayofmonth("ts") % 3 == 0) & (F.col("event_id") % 4 != 0)))
    loads = []
    for part in (documents.where(day % 3 != 0).unionByName(short), documents.where(day % 2 == 0)):
        raw_source.land_raw(part, root)
        rebuilt = arrivals.apply_late(spark, root, layout, checkpoint, CFG, pattern="*.txt", packed=True)
        loads.append(_stored(ledger.days(ledger.read_ledger(spark, layout.bronze)), "ledger"))
    before, after = loads[0].select("dt", F.col("_loaded_at").alias("_before")), loads[1]
    mart = spark.read.parquet(layout.mart("region_density")).groupBy("dt").agg(F.sum("aircraft_count").alias("aircraft"))
    reloaded = after.join(before, "dt").select("dt", (F.col("_loaded_at") > F.col("_before")).alias("reloaded"))
    return reloaded.withColumn("rebuilt", F.col("dt").isin(rebuilt)).join(mart, "dt", "left")


@query
def stream_late_reload(spark, sf_dir):
    """A third of the documents land a run later, and the last days are still
    open in the first run; days that closed or got late files are reloaded and
    the marts rebuilt, which must equal a build from complete data. The areas
    are given, and one of them is not that of its box."""
    layout = pipeline.Layout(scratch_path(spark, "lake"))
    areas = region_area(spark).withColumn("area_sqdeg", F.when(F.col("region") == "ukraine", 1000.0).otherwise(F.col("area_sqdeg")))
    root, checkpoint = scratch_path(spark, "raw"), scratch_path(spark, "checkpoint")
    documents = raw_documents(read_events(spark, sf_dir))
    late = F.xxhash64("value") % 3 == 0
    for part, before in ((documents.where(~late), LAST_DAY - timedelta(days=5)), (documents.where(late), None)):
        raw_source.land_raw(part, root)
        arrivals.apply_late(spark, root, layout, checkpoint, CFG, pattern="*.txt", packed=True, before=before, areas=areas)
    mart = spark.read.parquet(layout.mart("region_density"))
    return mart.select("snapshot_time", "region", "aircraft_count", "area_sqdeg", "density", "coverage_pct")


@query
def stream_alerts(spark, sf_dir):
    """The alert timeline from a stream that is stopped and started again.

    The first run (checkpoint) gets half of the ticks and is stopped; started
    again it gets the others and a sample that is too late to change what was
    sent. A second run with a new checkpoint reads the series from its start
    and finds that sample in its place.
    """
    path, source = scratch_path(spark, "alerts"), scratch_path(spark, "series")
    series = _stored(_series(spark, sf_dir), "series")
    rules = alerts.rule_table(spark, RULES)
    first, cut = scratch_path(spark, "checkpoint"), timeparts.instant(datetime(2024, 1, 16, 5))

    def run(checkpoint):
        arrivals.run_available(alert_jobs.alerts(alert_jobs.stream_series(spark, source), rules, path), checkpoint)
        return alert_jobs.read_states(spark, path)

    series.where(F.col("ts") < cut).write.mode("append").parquet(source)
    run(first)
    late = series.where("metric = 'freshness'").agg(
        F.max(F.when(F.col("ts") < cut, F.col("ts"))).alias("ts"), F.lit("freshness").alias("metric"), F.lit("").alias("label"),
        F.lit(1e9).alias("value"))
    late = late.withColumn("ts", F.col("ts") - F.make_dt_interval(mins=F.lit(30)))
    series.where(F.col("ts") >= cut).unionByName(late).write.mode("append").parquet(source)
    states = _stored(_timeline(run(first)).withColumn("run", F.lit("first")), "first-run")
    return states.unionByName(_timeline(run(scratch_path(spark, "checkpoint"))).withColumn("run", F.lit("second")))


@query
def stream_heartbeat(spark, sf_dir):
    """Silences between closed sessions of every user and of one source that sends all events, from a
    stream in two parts. A last sign of somebody else moves the watermark past all sessions."""
    path, source, checkpoint = (scratch_path(spark, name) for name in ("sessions", "signs", "checkpoint"))
    events = read_events(spark, sf_dir).select("ts", F.col("user_id").cast("string").alias("source"))
    signs = _stored(events.unionByName(events.withColumn("source", F.lit("all"))), "signs")
    silent_s = 6 * 3600
    cut = timeparts.instant(datetime(2024, 1, 16, 5))
    last = signs.agg(F.max("ts").alias("ts")).select(F.col("ts") + F.make_dt_interval(days=F.lit(2)), F.lit("clock"))
    for part in (signs.where(F.col("ts") < cut), signs.where(F.col("ts") >= cut), last.toDF("ts", "source")):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema("ts TIMESTAMP, source STRING").parquet(source)
        arrivals.run_available(alert_jobs.heartbeat(stream, ["source"], path, silent_s=silent_s), checkpoint)
    return alert_jobs.read_silences(spark, path, "source STRING", silent_s).where(F.col("next_seen").isNotNull())
