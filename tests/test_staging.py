import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from overflight.config import Box, Config, REGIONS
from overflight.functions.text import clean_text
from overflight.operators import density, staging
from overflight.operators.boxes import assign_box
from overflight.schemas import STAGING_COLUMNS
from overflight.sources.reference import box_table, region_area
from tests.helpers import bronze_frame, document, epoch, rows, vector

FAILS = (PySparkException, Py4JJavaError)
AT = epoch(2026, 7, 2, 12, 30)
EDGE = [
    vector(18, 42, icao24="r1"),
    vector(40, 42, icao24="r2"),
    vector(50, 42, icao24="r3"),
    vector(12, 52, icao24="r4"),
    vector(15, 48, icao24="r5"),
    vector(-10, 18, icao24="r6"),
    vector(70.01, 30, icao24="r7"),
    vector(None, 48, icao24="r8"),
    vector(30, 50, on_ground=True, icao24="r9"),
    vector(30, 50, on_ground=None, icao24="r10"),
    vector(5, 47, source=3, true_track=505.5, icao24="r11"),
    vector(5, 47, source=None, icao24="r12"),
    vector(5, 47, callsign=" " * 8, icao24="r13"),
    vector(5, 47, icao24="r14")[:16],
    vector(5, 47, icao24="r15") + [4],
    vector(5, 47, sensors=[1, 2], icao24="r16"),
]


@pytest.fixture(scope="module")
def edge(spark):
    return staging.stage(bronze_frame(spark, [document(AT, EDGE)])).persist()


def test_edge_rows(edge):
    found = {r.icao24: r for r in edge.collect()}
    assert edge.columns == list(STAGING_COLUMNS) and len(STAGING_COLUMNS) == 20
    assert set(found) == {f"r{n}" for n in range(1, 17)} - {"r7", "r8"}
    regions = {k: r.region for k, r in found.items()}
    assert regions == {
        "r1": "ukraine", "r2": "ukraine", "r3": "middle_east", "r4": "west_europe", "r5": "other", "r6": "other",
        "r9": "ukraine", "r10": "ukraine", **{f"r{n}": "west_europe" for n in range(11, 17)},
    }
    assert found["r13"].callsign is None and found["r1"].callsign == "TEST01"
    assert found["r14"].position_source is None and found["r15"].position_source == 0
    assert found["r16"].sensors == [1, 2] and found["r1"].sensors is None
    assert found["r1"].velocity == 200.0 and found["r1"].squawk == "1000" and found["r10"].on_ground is None


def test_edge_density(spark, edge):
    mart = density.region_density(edge, region_area(spark))
    assert rows(mart, "region", "aircraft_count", "area_sqdeg", "density") == [
        ("middle_east", 1, 540, 0.0019), ("ukraine", 2, 338, 0.0059), ("west_europe", 4, 70, 0.0571)]


def test_edge_cells(edge):
    cells = rows(density.grid_density(edge), "region", "cell_lon", "cell_lat", "aircraft_count")
    assert ("west_europe", 5.0, 47.0, 3) in cells and ("other", -10.0, 18.0, 1) in cells
    assert ("west_europe", 12.0, 52.0, 1) in cells
    assert sum(c[-1] for c in cells) == 9


@pytest.mark.parametrize("text", ['{"time": 1, "states": null}', '{"time": 1, "states": []}', '{"time": 1}',
                                  '{"time": 1, "states": "x"}'])
def test_no_states_no_rows(spark, text):
    bronze = bronze_frame(spark, [text])
    assert staging.stage(bronze).count() == 0
    assert bronze.select(staging.state_count("raw")).first()[0] == 0


def test_odd_elements_do_not_lose_the_others(spark):
    states = [vector(30, 50, icao24="a"), {"no": "vector"}, None, "text", 7, vector(30, 50, icao24="b")]
    bronze = bronze_frame(spark, [document(AT, states)])
    assert rows(staging.stage(bronze), "icao24") == [("a",), ("b",)]
    assert bronze.select(staging.state_count("raw")).first()[0] == 6


def test_numbers_keep_their_value(spark):
    text = '{"time": %d, "states": [%s]}' % (AT, '["a","b","c",1,2,2.50,5.0E1,1e-7,false,0,359.999999999,-12,null,-0.5,"0007",true,0]')
    row = staging.stage(bronze_frame(spark, [text])).first()
    assert (row.longitude, row.latitude, row.baro_altitude, row.true_track) == (2.5, 50.0, 1e-7, 359.999999999)
    assert (row.squawk, row.spi, row.geo_altitude) == ("0007", True, -0.5)


def test_bad_value_raises_or_is_found(spark):
    bronze = bronze_frame(spark, [document(AT, [vector(30, 50, velocity="fast"), vector(31, 50)])])
    with pytest.raises(FAILS):
        staging.stage(bronze).collect()
    loose = staging.stage(bronze, strict=False)
    assert rows(loose.where("velocity IS NULL"), "longitude") == [(30.0,)]
    failed = staging.cast_failures(staging.explode_states(bronze))
    assert [r.failed_fields for r in failed.collect()] == [["velocity"]]


def test_clean_text(spark):
    frame = spark.createDataFrame([(" A B\t",), ("　  ",), ("",), (None,), ("\r\nX ",)], "s STRING")
    assert [r[0] for r in frame.select(clean_text("s")).collect()] == ["A B", None, None, None, "X"]


def test_study_area_and_boxes_are_parameters(spark):
    cfg = Config(study_area=Box("korea", 124, 132, 33, 39), regions=(Box("south", 126, 130, 34, 38),), background="sea")
    states = [vector(127, 36, icao24="a"), vector(124, 39, icao24="b"), vector(30, 50, icao24="c")]
    staged = staging.stage(bronze_frame(spark, [document(AT, states)]), cfg)
    assert rows(staged, "icao24", "region") == [("a", "south"), ("b", "sea")]


def test_box_table_equals_rule(spark):
    grid = spark.range(81 * 43).select(
        (F.col("id") % 81 - 10.0).alias("longitude"), (F.floor(F.col("id") / 81) + 18.0).alias("latitude"))
    from overflight.functions.geo import tag_region

    ruled = grid.withColumn("region", tag_region("longitude", "latitude", REGIONS))
    for cell in ((5.0, 5.0), (0.7, 90.0)):
        assigned = assign_box(grid, box_table(spark), cell=cell)
        assert rows(assigned) == rows(ruled)


def test_boxes_over_each_other(spark):
    points = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0), (9.0, 9.0), (None, 2.0), (5.0, 5.0)], "longitude DOUBLE, latitude DOUBLE")
    areas = box_table(spark, [Box(f"b{n}", 0, n, 0, n) for n in range(6, 0, -1)])
    assert rows(assign_box(points, areas).na.fill(-1.0)) == [
        (-1.0, 2.0, "other"), (1.0, 1.0, "b6"), (1.0, 1.0, "b6"), (5.0, 5.0, "b6"), (9.0, 9.0, "other")]


def test_planning_runs_no_job(spark):
    from overflight.operators import density, points, profile

    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "plans only")
    stg = spark.createDataFrame([], "snapshot_time TIMESTAMP, region STRING, longitude DOUBLE, latitude DOUBLE, callsign STRING, "
                                "origin_country STRING, baro_altitude DOUBLE, velocity DOUBLE, on_ground BOOLEAN, position_source BIGINT")
    assign_box(stg, box_table(spark))
    profile.source_profile(stg)
    density.grid_mart(stg, density.daily_coverage(stg))
    points.aircraft_points(stg, first_per_bucket=True)
    assert list(tracker.getJobIdsForGroup("planning")) == []
    spark.sparkContext.setJobGroup("", "")
