from datetime import date, datetime, timedelta

import pytest

from overflight.config import Config
from overflight.operators import metrics, quality
from overflight.plans import pipeline
from overflight.sources.bronze import load_days, read_bronze
from overflight.sources.reference import read_region_area, region_area
from overflight.streaming import arrivals
from tests.helpers import document, epoch, rows, vector, write_file

DAYS = [date(2026, 7, d) for d in (1, 2, 3)]
AS_OF = datetime(2026, 7, 4, 1, 30)
TABLES = ("region_density", "grid_density", "aircraft_points")


def land(root, day, minute, states, name="a"):
    t = epoch(2026, 7, day, 6, minute)
    write_file(root, "global", f"2026070{day}", f"{name}_{t}.json", document(t, states))


@pytest.fixture
def lake(spark, tmp_path):
    root = tmp_path / "raw"
    for day in (1, 2, 3):
        for minute in (0, 10, 30):
            land(root, day, minute, [vector(30 + day, 50), vector(5, 46 + minute / 10), vector(0, 20)])
    layout = pipeline.Layout(str(tmp_path / "lake"))
    load_days(spark, str(root), layout.bronze, [f"{d:%Y%m%d}" for d in DAYS], loaded_at=datetime(2026, 7, 4))
    return root, layout


def contents(spark, layout):
    read = lambda path: rows(spark.read.parquet(path).select(
        *sorted(spark.read.parquet(path).drop("_loaded_at", "sensors").columns)).na.fill("").na.fill(-1))
    return {name: read(layout.mart(name)) for name in TABLES} | {"states": read(layout.staging), "cov": read(layout.coverage)}


def test_full_build(spark, lake):
    _, layout = lake
    built = pipeline.build(spark, layout, as_of=AS_OF)
    assert built["states"].count() == 27
    assert built["region_density"].count() == 18
    assert built["aircraft_points"].count() == 18
    assert rows(spark.read.parquet(layout.coverage), "snapshots_observed") == [(3,), (3,), (3,)]
    current = metrics.read_current(spark, layout.metrics)
    assert rows(current.where("metric = 'query_success'"), "value") == [(1.0,)]
    assert rows(current.where("metric = 'freshness'"), "value") == [(5400.0,)]
    assert rows(current.where("metric = 'last_success'"), "value") == [(float(epoch(2026, 7, 4, 1, 30)),)]


def test_rebuilding_changed_days_equals_a_full_build(spark, lake, tmp_path):
    root, layout = lake
    pipeline.build(spark, layout, as_of=AS_OF)
    land(root, 2, 40, [vector(40, 30)] * 3, "late")
    for p in (root / "region=global" / "dt=20260703").iterdir():
        t = int(p.stem.split("_")[1])
        p.write_text(document(t, [vector(127, 37)]))  # day 3 leaves the study area altogether
    load_days(spark, str(root), layout.bronze, ["20260702", "20260703"], loaded_at=datetime(2026, 7, 4))
    pipeline.build(spark, layout, days=DAYS[1:], as_of=AS_OF)
    fresh = pipeline.Layout(layout.root, env="trial")
    pipeline.build(spark, fresh, as_of=AS_OF)
    assert fresh.mart("x") != layout.mart("x") and fresh.bronze == layout.bronze
    partial, full = contents(spark, layout), contents(spark, fresh)
    assert partial == full
    assert {r[-1] for r in rows(spark.read.parquet(layout.mart("region_density")), "aircraft_count", "dt")} == set(DAYS[:2])


def test_stale_bronze_stops_the_build(spark, lake):
    _, layout = lake
    with pytest.raises(quality.GateError, match="freshness"):
        pipeline.build(spark, layout, as_of=datetime(2026, 7, 8))
    with pytest.raises(Exception):
        spark.read.parquet(layout.staging)


def test_incomplete_days_warn_only(spark, lake):
    _, layout = lake
    results = quality.run_gates(pipeline.gate_results(spark, layout, Config(), AS_OF))
    assert {(r.check_name, r.status) for r in results} == {("freshness", "pass"), ("daily_completeness", "warn")}


def test_bad_staging_stops_before_the_marts(spark, lake):
    root, layout = lake
    land(root, 1, 50, [vector(30, 50, velocity=-5)])
    load_days(spark, str(root), layout.bronze, ["20260701"])
    with pytest.raises(quality.GateError, match=r"states.accepted_range\(velocity\): 1"):
        pipeline.build(spark, layout, as_of=AS_OF)
    with pytest.raises(Exception):
        spark.read.parquet(layout.mart("region_density"))


def test_a_bad_late_file_stops_the_reload(spark, tmp_path):
    root, layout, cp = tmp_path / "raw", pipeline.Layout(str(tmp_path / "lake")), str(tmp_path / "cp")
    land(root, 1, 0, [vector(30, 50)])
    arrivals.apply_late(spark, str(root), layout, cp)
    before = rows(spark.read.parquet(layout.mart("region_density")), "snapshot_time", "aircraft_count")
    land(root, 1, 30, [vector(30, 50, velocity=-5)])
    for _ in range(2):  # the day stays due until its file is mended
        with pytest.raises(quality.GateError, match=r"states.accepted_range\(velocity\): 1"):
            arrivals.apply_late(spark, str(root), layout, cp)
    assert rows(spark.read.parquet(layout.mart("region_density")), "snapshot_time", "aircraft_count") == before
    land(root, 1, 30, [vector(30, 50)])
    arrivals.apply_late(spark, str(root), layout, cp)
    assert spark.read.parquet(layout.mart("region_density")).count() == 2


def test_every_declared_check_runs(spark, lake):
    _, layout = lake
    areas = region_area(spark)
    results = pipeline.check_layers(areas, pipeline.build(spark, layout, as_of=AS_OF))
    ran = {(r.relation, r.check_name, r.column_name) for r in results.collect()}
    assert ran == {(name, c.kind, c.column) for name, checks in quality.declared_checks().items() for c in checks}


def test_areas_from_a_file(spark, lake, tmp_path):
    (tmp_path / "areas.csv").write_text("region,area_sqdeg\nukraine,1.25\nwest_europe,2.5\n")
    _, layout = lake
    built = pipeline.build(spark, layout, as_of=AS_OF, areas=read_region_area(spark, str(tmp_path / "areas.csv")))
    assert rows(built["region_density"].where("dt = DATE '2026-07-01'"), "region", "density") == [
        ("ukraine", 0.8)] * 3 + [("west_europe", 0.4)] * 3


def test_off_scale_track_of_other_sources_does_not_block(spark, lake):
    root, layout = lake
    land(root, 1, 50, [vector(30, 50, source=3, true_track=505.5)])
    load_days(spark, str(root), layout.bronze, ["20260701"])
    pipeline.build(spark, layout, as_of=AS_OF)


def test_failed_refresh_is_a_metric(spark, tmp_path):
    layout = pipeline.Layout(str(tmp_path / "nothing"))
    assert not pipeline.refresh_metrics(spark, layout, AS_OF)
    assert rows(metrics.read_current(spark, layout.metrics), "metric", "value") == [("query_success", 0.0)]


def test_last_good_values_survive_a_failed_refresh(spark, lake):
    _, layout = lake
    pipeline.build(spark, layout, as_of=AS_OF)
    good = rows(metrics.read_current(spark, layout.metrics).where("metric <> 'query_success'"))
    broken = pipeline.Layout(layout.root, env="trial")
    assert not pipeline.refresh_metrics(spark, broken, AS_OF + timedelta(minutes=5), into=layout.metrics)
    current = metrics.read_current(spark, layout.metrics)
    assert rows(current.where("metric <> 'query_success'")) == good
    assert rows(current.where("metric = 'query_success'"), "value") == [(0.0,)]


def test_day_filters_prune_files(spark, lake):
    _, layout = lake
    bronze = read_bronze(spark, layout.bronze, DAYS[:1])
    assert len(bronze.inputFiles()) >= 1
    plan = bronze.select("snapshot_time")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan or "dt" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "raw" not in plan.split("ReadSchema")[1]
    from overflight.operators.completeness import incomplete_days

    plan = incomplete_days(read_bronze(spark, layout.bronze), AS_OF)._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert ">= 2026-07-01" in filters and "< 2026-07-04" in filters


def test_staged_position_filter_precedes_the_casts(spark, lake):
    from overflight.operators.staging import stage

    _, layout = lake
    # plans read top-down: projection, then filter, then explode
    plan = stage(read_bronze(spark, layout.bronze))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("icao24") < plan.index("Filter") < plan.index("Generate")
