from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from overflight.functions import geo, status, timeparts
from overflight.operators import boxes, density, points, profile, staging
from overflight.sources.reference import box_table, read_region_area, region_area
from tests.helpers import bronze_frame, document, epoch, rows, vector


def snap(hour, minute, states, day=2, second=0):
    return document(epoch(2026, 7, day, hour, minute, second), states)


FLYING = [vector(30, 50), vector(40, 30), vector(5, 47), vector(5.2, 47.3), vector(0, 20), vector(30, 50, on_ground=True)]


@pytest.fixture(scope="module")
def stg(spark):
    docs = [
        snap(12, 0, FLYING),
        snap(12, 10, FLYING[:1]),
        snap(12, 20, [vector(30, 50, on_ground=True)]),  # staged, so it counts for coverage
        snap(12, 30, FLYING[2:4]),
        snap(12, 40, [vector(127, 37)]),  # outside: nothing staged
        snap(0, 0, FLYING, day=3),
    ]
    return staging.stage(bronze_frame(spark, docs)).persist()


def test_coverage_counts_staged_snapshots(stg):
    assert rows(density.daily_coverage(stg)) == [(date(2026, 7, 2), 4, 0.028), (date(2026, 7, 3), 1, 0.007)]


def test_coverage_may_exceed_one(spark):
    docs = [snap(0, m, FLYING[:1], second=s) for m in range(6) for s in (0, 7)]
    stg = staging.stage(bronze_frame(spark, docs))
    assert rows(density.daily_coverage(stg, expected=6), "coverage_pct") == [(2.0,)]
    mart = density.region_density(stg, region_area(spark), expected=6)
    assert {r.coverage_pct for r in mart.collect()} == {2.0}


def test_region_density(spark, stg):
    mart = density.region_density(stg, region_area(spark))
    t = lambda h, m, d=2: datetime(2026, 7, d, h, m)
    assert rows(mart, "snapshot_time", "region", "aircraft_count", "density", "coverage_pct") == [
        (t(12, 0), "middle_east", 1, 0.0019, 0.028), (t(12, 0), "ukraine", 1, 0.003, 0.028),
        (t(12, 0), "west_europe", 2, 0.0286, 0.028), (t(12, 10), "ukraine", 1, 0.003, 0.028),
        (t(12, 30), "west_europe", 2, 0.0286, 0.028),
        (t(0, 0, 3), "middle_east", 1, 0.0019, 0.007), (t(0, 0, 3), "ukraine", 1, 0.003, 0.007),
        (t(0, 0, 3), "west_europe", 2, 0.0286, 0.007),
    ]


def test_stored_coverage_gives_the_same_mart(spark, stg):
    areas = region_area(spark)
    joined = density.region_density(stg, areas, density.daily_coverage(stg))
    assert rows(joined) == rows(density.region_density(stg, areas))


def test_zero_filled(spark, stg):
    mart = density.region_density(stg, region_area(spark), fill_zero=True)
    assert mart.count() == 5 * 3
    sparse = density.region_density(stg, region_area(spark))
    assert rows(mart.where("aircraft_count > 0")) == rows(sparse)
    assert rows(mart.where("aircraft_count = 0").select("density").distinct()) == [(0.0,)]


def test_quarter_cells_add_up(stg):
    coarse = density.grid_density(stg, 0.5)
    fine = density.grid_density(stg, 0.25)
    summed = fine.groupBy(
        "dt", "region", geo.snap_to_grid("cell_lon", 0.5).alias("cell_lon"), geo.snap_to_grid("cell_lat", 0.5).alias("cell_lat")
    ).agg(F.sum("aircraft_count"))
    assert rows(summed) == rows(coarse)


def test_grid_mart_and_reads(stg):
    grid = density.grid_mart(stg, density.daily_coverage(stg))
    assert grid.columns == ["dt", "region", "cell_lon", "cell_lat", "aircraft_count", "coverage_pct"]
    latest = density.grid_latest(grid)
    assert {r.dt for r in latest.collect()} == {date(2026, 7, 3)} and latest.count() == 4
    trend = density.grid_trend(grid, region="west_europe", cell=(5, 47)).collect()
    assert [(r.dt, r.aircraft_count) for r in trend] == [(date(2026, 7, 2), 4), (date(2026, 7, 3), 2)]


def test_points_keep_half_hour_frames(stg):
    pts = points.aircraft_points(stg)
    assert len(pts.columns) == 9
    assert {r.snapshot_bucket for r in pts.collect()} == {
        datetime(2026, 7, 2, 12, 0), datetime(2026, 7, 2, 12, 30), datetime(2026, 7, 3)}
    assert pts.count() == 12 and pts.where("region = 'other'").count() == 2


def test_first_frame_per_bucket_survives_drift(spark):
    docs = [snap(11, 59, FLYING[:1]), snap(12, 9, FLYING[:1]), snap(12, 31, FLYING[:1], second=4)]
    stg = staging.stage(bronze_frame(spark, docs))
    assert points.aircraft_points(stg).count() == 0
    pts = points.aircraft_points(stg, first_per_bucket=True)
    assert rows(pts, "snapshot_bucket", "snapshot_time") == [
        (datetime(2026, 7, 2, 11, 30), datetime(2026, 7, 2, 11, 59)),
        (datetime(2026, 7, 2, 12, 0), datetime(2026, 7, 2, 12, 9)),
        (datetime(2026, 7, 2, 12, 30), datetime(2026, 7, 2, 12, 31, 4))]


def test_export_is_ordered_and_skips_empty(spark, stg, tmp_path):
    pts, out = points.aircraft_points(stg), str(tmp_path / "map")
    assert points.export_points(pts, datetime(2026, 7, 4), out, days=3)
    stored = spark.read.parquet(out)
    assert stored.columns[0] == "ts" and stored.count() == 12
    assert rows(stored.select("ts").distinct())[0] == ("2026-07-02T12:00:00",)
    assert not points.export_points(pts, datetime(2026, 8, 4), out, days=3)
    assert spark.read.parquet(out).count() == 12
    assert points.recent_points(pts, datetime(2026, 7, 5), days=2).count() == 5


def test_playback_window_includes_both_ends(stg):
    window = points.playback_window(points.aircraft_points(stg), timedelta(minutes=30))
    assert {r.snapshot_bucket.minute for r in window.collect()} == {0, 30}
    assert window.count() == 7


def test_contrast_to_baseline(spark):
    mart = spark.createDataFrame(
        [("west_europe", 6.93), ("ukraine", 0.83), ("middle_east", 0.27), ("middle_east", 0.27)], "region STRING, density DOUBLE")
    assert rows(density.density_contrast(mart)) == [
        ("middle_east", 0.27, 25.7), ("ukraine", 0.83, 8.3), ("west_europe", 6.93, 1.0)]


def test_exact_median_with_a_hot_key(spark):
    rng = np.random.default_rng(7)
    data = [(0, float(v)) for v in rng.normal(size=20001)] + [(0, 1.5)] * 9000 + [(3, float(v)) for v in range(10)]
    data += [(None, 2.0), (None, 4.0), (5, None)]
    frame = spark.createDataFrame(data, "k INT, v DOUBLE").repartition(8).withColumn("w", -F.col("v"))
    got = {(r.k, r.metric): r["median"] for r in profile.exact_median(frame, "k", ["v", "w"], accuracy=100).collect()}
    hot = float(np.median([v for k, v in data if k == 0]))
    assert got == {(0, "v"): hot, (0, "w"): -hot, (3, "v"): 4.5, (3, "w"): -4.5, (None, "v"): 3.0, (None, "w"): -3.0}


def test_source_profile_and_first_day(spark):
    docs = [snap(12, 0, [vector(5, 47, velocity=100), vector(5, 47, velocity=200), vector(5, 47, source=3, velocity=40),
                         vector(5, 47, source=None, baro_altitude=None)])]
    stg = staging.stage(bronze_frame(spark, docs))
    got = {r.position_source: (r.rows, r.median_velocity, r.median_altitude) for r in profile.source_profile(stg).collect()}
    assert got == {0: (2, 150.0, 1000.5), 3: (1, 40.0, 1000.5), None: (1, 200.0, None)}
    assert profile.source_first_seen(stg).where("position_source = 3").first().first_day == date(2026, 7, 2)


def test_areas(spark, tmp_path):
    expected = [("middle_east", 540), ("ukraine", 338), ("west_europe", 70)]
    assert rows(region_area(spark)) == expected
    (tmp_path / "a.csv").write_text("region,area_sqdeg\nukraine,338\nmiddle_east,540\nwest_europe,70\n")
    assert rows(read_region_area(spark, str(tmp_path / "a.csv"))) == expected


def test_credits(spark):
    areas = spark.createDataFrame([(25.0,), (25.1,), (100.0,), (400.0,), (400.1,), (64800.0,)], "a DOUBLE")
    assert [r[0] for r in areas.select(geo.credit_cost(F.col("a"))).collect()] == [1, 2, 2, 3, 4, 4]
    budget = {r.region: (r.credits_per_day, r.budget_pct) for r in boxes.credit_budget(box_table(spark)).collect()}
    assert budget == {"ukraine": (432, 10.8), "middle_east": (576, 14.4), "west_europe": (288, 7.2)}


def test_geojson(spark):
    import json

    doc = json.loads(boxes.region_geojson(box_table(spark)).first()[0])
    ring = {f["properties"]["region"]: f["geometry"]["coordinates"][0] for f in doc["features"]}
    assert doc["type"] == "FeatureCollection" and len(ring) == 3
    assert ring["ukraine"] == [[18, 42], [44, 42], [44, 55], [18, 55], [18, 42]]


def test_time_expressions(spark):
    frame = spark.createDataFrame([(datetime(2026, 7, 2, 12, 44, 59),)], "ts TIMESTAMP")
    assert frame.select(timeparts.time_bucket("ts", 1800)).first()[0] == datetime(2026, 7, 2, 12, 30)
    assert frame.select(timeparts.iso_seconds("ts")).first()[0] == "2026-07-02T12:44:59"
    assert frame.select(timeparts.age_seconds(datetime(2026, 7, 2, 12, 45, 1), "ts")).first()[0] == 2
    spans = {172800.0: "2d 0h 0m 0s", 93784.0: "1d 2h 3m 4s", 3600.0: "1h 0m 0s", 61.0: "1m 1s", 59.0: "59s", 0.0: "0s", -61.0: "-1m 1s"}
    secs = spark.createDataFrame([(s,) for s in spans], "s DOUBLE")
    assert [r[0] for r in secs.select(timeparts.humanize_duration("s")).collect()] == list(spans.values())


def test_status_steps(spark):
    frame = spark.createDataFrame([(0.79,), (0.8,), (1.0,), (2.0,), (None,)], "v DOUBLE")
    got = [r[0] for r in frame.select(status.status_steps("v", status.COVERAGE_STEPS)).collect()]
    assert got == ["red", "yellow", "green", "green", None]
    ages = spark.createDataFrame([(129599,), (129600,), (172800,)], "v BIGINT")
    assert [r[0] for r in ages.select(status.status_steps("v", status.FRESHNESS_STEPS)).collect()] == ["green", "yellow", "red"]
    flags = spark.createDataFrame([(1.0,), (0.0,), (0.5,)], "v DOUBLE")
    assert [r[0] for r in flags.select(status.map_values("v", status.SUCCESS_LABELS)).collect()] == ["OK", "FAIL", "0.5"]


def test_the_newest_day_opens_no_older_files(spark, tmp_path):
    from datetime import datetime

    from overflight.operators.completeness import lately, mart_freshness

    path = str(tmp_path / "mart")
    spark.sql("SELECT make_timestamp(2026, 7, d, 6, 0, 0) AS snapshot_time, make_date(2026, 7, d) AS dt FROM (SELECT explode(sequence(1, 30)) AS d)") \
        .write.partitionBy("dt").parquet(path)
    mart = spark.read.parquet(path)
    assert len(lately(mart, datetime(2026, 7, 30, 2)).inputFiles()) == 30  # listed, and pruned when read:
    plan = mart_freshness(mart, datetime(2026, 7, 30, 2))._jdf.queryExecution().executedPlan().toString()
    assert ">= 2026-07-23" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert mart_freshness(mart, datetime(2026, 7, 31, 2)).first().status == "ok"
    late = mart_freshness(mart, datetime(2026, 9, 1, 2)).first()  # nothing lately: the whole table is asked
    assert (late.newest, late.status) == (datetime(2026, 7, 30, 6), "stale")
