"""Publishing after audit, rebuilds by fingerprint, folded values, curve order, box levels, bitmaps."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window, functions as F

from overflight.config import Config
from overflight.operators import boxes, density, metrics, quality, staging
from overflight.plans import pipeline
from overflight.sources import ledger
from overflight.sources.bronze import load_days, read_bronze
from overflight.sources.reference import literal_table, region_area
from overflight.sources.storage import write_days
from overflight.streaming import runs
from tests.helpers import document, epoch, rows, vector, write_file

BOXES = "region STRING, priority INT, lomin DOUBLE, lomax DOUBLE, lamin DOUBLE, lamax DOUBLE"


def load(spark, tmp_path, layout, day, *snapshots):
    """Replace a day by snapshots of (minute, vectors)."""
    root = tmp_path / f"raw-{day}-{len(list(tmp_path.iterdir()))}"
    for minute, states in snapshots:
        write_file(root, "global", f"2026070{day}", f"{minute}.json", document(epoch(2026, 7, day, 6, minute), states))
    load_days(spark, str(root), layout.bronze, [f"2026070{day}"])


@pytest.fixture
def lake(spark, tmp_path):
    layout = pipeline.Layout(str(tmp_path / "lake"))
    for day in (1, 2):
        load(spark, tmp_path, layout, day, (0, [vector(30, 50)]), (10, [vector(5, 46)] * 2))
    return layout


def mart(spark, layout):
    return rows(spark.read.parquet(layout.mart("region_density")), "dt", "snapshot_time", "region", "aircraft_count")


def test_a_failed_check_publishes_nothing(spark, tmp_path, lake):
    pipeline.checked_layers(spark, lake, Config())
    before = mart(spark, lake)
    load(spark, tmp_path, lake, 2, (0, [vector(30, 50, velocity=-5)] * 7))
    with pytest.raises(quality.GateError, match="velocity"):
        pipeline.rebuild_changed(spark, lake)
    assert mart(spark, lake) == before
    assert spark.read.parquet(lake.staging).where("velocity < 0").isEmpty()
    load(spark, tmp_path, lake, 2, (0, [vector(30, 50)] * 7))
    assert pipeline.rebuild_changed(spark, lake) == [date(2026, 7, 2)]
    assert mart(spark, lake)[-1] == (date(2026, 7, 2), datetime(2026, 7, 2, 6, 0), "ukraine", 7)
    assert mart(spark, lake)[:2] == before[:2]


def test_only_changed_days_are_rebuilt(spark, tmp_path, lake):
    assert pipeline.rebuild_changed(spark, lake) == [date(2026, 7, 1), date(2026, 7, 2)]
    assert pipeline.rebuild_changed(spark, lake) == []
    load(spark, tmp_path, lake, 1, (10, [vector(5, 46)] * 2), (0, [vector(30, 50)]))  # the same, loaded later
    assert pipeline.rebuild_changed(spark, lake) == []
    load(spark, tmp_path, lake, 1, (0, [vector(30, 50)]))
    assert rows(pipeline.changed_days(spark, lake, Config())) == [(date(2026, 7, 1), True), (date(2026, 7, 2), False)]
    assert pipeline.rebuild_changed(spark, lake) == [date(2026, 7, 1)]
    # other parameters or other areas make every day due
    assert pipeline.rebuild_changed(spark, lake, Config(cell_deg=0.25), [date(2026, 7, 2)]) == [date(2026, 7, 2)]
    areas = region_area(spark).withColumn("area_sqdeg", F.col("area_sqdeg") + 1)
    assert pipeline.rebuild_changed(spark, lake, areas=areas) == [date(2026, 7, 1), date(2026, 7, 2)]
    assert rows(spark.read.parquet(lake.mart("region_density")).select("area_sqdeg").distinct()) == [(71.0,), (339.0,)]


def test_fingerprints_add_up_and_forget_order(spark, lake):
    bronze = read_bronze(spark, lake.bronze)
    whole = rows(ledger.days(ledger.entries(bronze)), "dt", "documents", "fingerprint")
    parts = ledger.entries(bronze.where(F.minute("snapshot_time") == 0)).unionByName(ledger.entries(bronze.where(F.minute("snapshot_time") > 0)))
    assert rows(ledger.days(parts), "dt", "documents", "fingerprint") == whole
    again = ledger.entries(bronze.orderBy(F.desc("snapshot_time")).withColumn("_loaded_at", F.current_timestamp()))
    assert rows(ledger.days(again), "dt", "documents", "fingerprint") == whole
    other = ledger.entries(bronze.withColumn("raw", F.concat("raw", F.lit(" "))))
    assert {r[2] for r in rows(ledger.days(other), "dt", "documents", "fingerprint")}.isdisjoint(r[2] for r in whole)


def spoil(folder, keep):
    for file in folder.rglob("*.parquet"):
        if keep not in str(file):
            file.write_bytes(b"no parquet")
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)


def test_the_latest_day_opens_no_other_file(spark, tmp_path, lake):
    pipeline.checked_layers(spark, lake, Config())
    expected = rows(density.latest_day(spark.read.parquet(lake.mart("grid_density"))), "cell_lon", "aircraft_count", "dt")
    schema = "region STRING, cell_lon DOUBLE, cell_lat DOUBLE, aircraft_count BIGINT, coverage_pct DOUBLE, dt DATE"
    spoil(tmp_path / "lake" / "marts" / "grid_density", "dt=2026-07-02")
    got = pipeline.latest_published(spark, lake, "grid_density", schema)
    assert rows(got, "cell_lon", "aircraft_count", "dt") == expected != []
    assert rows(pipeline.built_days(spark, lake, "grid_density")) == [(date(2026, 7, 1), 2), (date(2026, 7, 2), 2)]


def test_folded_metrics(spark, tmp_path):
    root = str(tmp_path / "metrics")
    start = datetime(2026, 7, 1, 23, 50)

    def tick(n, *values):
        taken = spark.createDataFrame(list(values), "kind STRING, label STRING, value DOUBLE")
        metrics.write_metrics(taken, start + timedelta(minutes=5 * n), root)

    tick(0, ("a", "x", 1.0), ("a", "y", 2.0), ("old", "", 9.0))
    tick(1, ("a", "x", 3.0))
    tick(2, ("b", "", 4.0))  # after midnight
    whole = rows(metrics.read_current(spark, root))
    assert [r[1:] for r in whole] == [("old", "", 9.0), ("a", "x", 3.0), ("b", "", 4.0)]
    for _ in range(2):
        metrics.fold_history(spark, root, date(2026, 7, 2))
        assert rows(metrics.read_current(spark, root)) == whole
    spoil(tmp_path / "metrics" / "history", "dt=2026-07-02")  # folded ticks are not opened again
    assert rows(metrics.read_current(spark, root)) == whole
    tick(3, ("a", "x", 5.0))
    assert [r[1:] for r in rows(metrics.read_current(spark, root))] == [("old", "", 9.0), ("b", "", 4.0), ("a", "x", 5.0)]


def test_folded_updates(spark, tmp_path):
    path, schema = str(tmp_path / "updates"), "k STRING, v BIGINT"
    spark.range(1).select(F.lit(datetime(2026, 7, 1)).alias("started_at")).write.parquet(f"{path}/runs/run=r")

    def batch(n, *values):
        spark.createDataFrame(list(values), schema).write.parquet(f"{path}/rows/run=r/batch_id={n}")

    read = lambda: rows(runs.read_latest(spark, path, ["k"], schema))
    batch(0, ("a", 1), ("b", 1))
    batch(1, ("a", 2))
    assert read() == [("a", 2), ("b", 1)]
    runs.fold(spark, path, ["k"], schema)
    spoil(tmp_path / "updates" / "rows", "nothing")
    assert read() == [("a", 2), ("b", 1)]
    batch(2, ("b", 5))
    assert read() == [("a", 2), ("b", 5)]
    runs.fold(spark, path, ["k"], schema)
    runs.fold(spark, path, ["k"], schema)
    assert read() == [("a", 2), ("b", 5)]
    # another run starts from nothing
    spark.range(1).select(F.lit(datetime(2026, 7, 2)).alias("started_at")).write.parquet(f"{path}/runs/run=s")
    spark.createDataFrame([("c", 1)], schema).write.parquet(f"{path}/rows/run=s/batch_id=0")
    assert read() == [("c", 1)]


def test_boxes_of_any_size(spark):
    draw = random.Random(4)
    table = [("world", 10_000, -180.0, 180.0, -90.0, 90.0), ("point", 0, 5.0, 5.0, 5.0, 5.0), ("edge", 1, 0.0, 4.0, 0.0, 4.0)]
    for n in range(60):
        side = 0.05 * 2 ** draw.uniform(0, 12)
        lo, la = draw.uniform(-170, 100), draw.uniform(-80, 50)
        table.append((f"box{n}", n + 2, lo, lo + side, la, la + side * draw.uniform(0.01, 1)))
    areas = literal_table(spark, table, BOXES)
    spots = [(draw.uniform(-190, 190), draw.uniform(-95, 95)) for _ in range(800)]
    spots += [(x, y) for _, _, a, b, c, d in table for x in (a, b) for y in (c, d)] + [(None, 1.0), (5.0, 5.0)]
    points = spark.createDataFrame(spots, "longitude DOUBLE, latitude DOUBLE")

    def first(x, y):
        inside = [b for b in table if x is not None and b[2] <= x <= b[3] and b[4] <= y <= b[5]]
        return min(inside, key=lambda b: b[1])[0] if inside else "other"

    for cell, levels in (((0.1, 0.1), boxes.LEVELS), ((5.0, 5.0), 5), ((30.0, 20.0), 1)):
        got = {(r.longitude, r.latitude): r.region for r in boxes.assign_box(points, areas, cell=cell, levels=levels).collect()}
        assert got == {spot: first(*spot) for spot in spots}
    index = boxes.box_index(areas, (0.1, 0.1)).groupBy("region").count()
    assert index.agg(F.max("count")).first()[0] <= 4 and index.count() == len(table)


def test_boxes_in_crowds(spark):
    """Many boxes over each other, copies and touching edges among them, against every box by hand."""
    draw = random.Random(9)
    table = [("world", 10_000, -180.0, 180.0, -90.0, 90.0)]
    for n in range(900):
        side = 0.1 * 2 ** draw.randrange(11)
        lo, la = (draw.randrange(-200, 800) / 10, draw.randrange(100, 600) / 10)
        table.append((f"box{n}", draw.randrange(3000), lo, lo + side, la, la + side * draw.choice((0.01, 1))))
    table += [(f"copy{n}", 4000 + n, 20.0, 30.0, 20.0, 30.0) for n in range(200)]
    areas = literal_table(spark, table, BOXES)
    spots = [(draw.uniform(-190, 190), draw.uniform(-95, 95)) for _ in range(300)]
    spots += [(draw.randrange(-200, 800) / 10, draw.randrange(100, 600) / 10) for _ in range(1200)] + [(None, 1.0)]
    spots += [(x, y) for _, _, a, b, c, d in table[:200] for x in (a, b) for y in (c, d)]
    points = spark.createDataFrame(spots, "longitude DOUBLE, latitude DOUBLE")

    def first(x, y):
        inside = [b for b in table if x is not None and b[2] <= x <= b[3] and b[4] <= y <= b[5]]
        return min(inside, key=lambda b: b[1:2] + b[:1])[0] if inside else "other"

    for cell, levels, most in (((0.1, 0.1), boxes.LEVELS, boxes.MOST), ((0.7, 0.3), 4, 2)):
        lists = boxes.box_lists(areas, cell, levels, most)
        assert lists.where("level > 0").agg(F.max(F.size("boxes"))).first()[0] <= most + 1
        got = {(r.longitude, r.latitude): r.region for r in boxes.assign_box(points, areas, cell=cell, levels=levels, lists=lists).collect()}
        assert got == {spot: first(*spot) for spot in spots}


def test_coverage_of_overlapping_parts(spark, tmp_path, lake):
    load(spark, tmp_path, lake, 3, *[(m, [vector(30, 50), vector(5, 46)]) for m in range(0, 60, 7)])
    stg = staging.stage(read_bronze(spark, lake.bronze))
    parts = density.coverage_parts(stg, "region").unionByName(density.coverage_parts(stg.where("region = 'ukraine'"), "region"))
    assert rows(density.coverage_of_parts(parts)) == rows(density.daily_coverage(stg)) != []
    late = density.coverage_parts(stg.where(F.minute("snapshot_time") > 30))
    once = density.merged_parts(density.coverage_parts(stg).unionByName(late))
    assert rows(density.coverage_of_parts(once)) == rows(density.daily_coverage(stg))


def test_curve_keeps_cells_together(spark, tmp_path):
    cells = spark.range(64 * 64).select((F.col("id") % 64 / 2).alias("cell_lon"), (F.floor(F.col("id") / 64) / 2).alias("cell_lat"))
    number = density.morton("cell_lon", "cell_lat")
    numbered = cells.select("cell_lon", "cell_lat", number.alias("n"))
    assert numbered.select("n").distinct().count() == 64 * 64
    bits = lambda v: sum((v >> i & 1) << 2 * i for i in range(16))
    for r in numbered.sample(0.02, 1).collect():
        assert r.n == bits(int((r.cell_lon + 180) * 2)) | bits(int((r.cell_lat + 90) * 2)) << 1
    # of a file in this order, few blocks of 64 rows can hold a cell by their bounds
    block = F.floor((F.row_number().over(Window.orderBy("n")) - 1) / 64)
    bounds = numbered.withColumn("block", block).groupBy("block").agg(
        F.min("cell_lon").alias("a"), F.max("cell_lon").alias("b"), F.min("cell_lat").alias("c"), F.max("cell_lat").alias("d"))
    assert bounds.where("7.5 BETWEEN a AND b AND 20.0 BETWEEN c AND d").count() <= 4


def test_a_cells_trend_reads_few_row_groups(spark, tmp_path):
    path = str(tmp_path / "grid")
    day = F.lit(date(2026, 7, 1))
    cells = spark.range(200 * 200).select(
        day.alias("dt"), F.lit("other").alias("region"), (F.col("id") % 200 / 2 - 20).alias("cell_lon"),
        (F.floor(F.col("id") / 200) / 2 - 40).alias("cell_lat"), F.col("id").alias("aircraft_count"))
    spark.conf.set("parquet.block.size", 32_768)
    spark.conf.set("parquet.page.row.count.limit", 500)
    try:
        write_days(cells.orderBy(F.rand(1)), path, order=[density.morton("cell_lon", "cell_lat")])
    finally:
        spark.conf.unset("parquet.block.size")
        spark.conf.unset("parquet.page.row.count.limit")
    trend = density.grid_trend(spark.read.parquet(path), cell=(3.5, 7.0))
    assert trend.count() == 1
    text = trend._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(cell_lon,3.5)" in text and "EqualTo(cell_lat,7.0)" in text
    seen = spark.read.parquet(path).where("cell_lon = 3.5 AND cell_lat = 7.0")
    scan = seen.select("aircraft_count")
    scan.collect()
    metric = scan._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().get("numOutputRows").get().value()
    assert 1 <= metric < 4000  # of 40,000
