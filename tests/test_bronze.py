from datetime import date, datetime

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from overflight.functions.timeparts import compact_day
from overflight.sources import bronze, raw
from overflight.sources.storage import layer_name, materialize, replace_days, write_days
from overflight.schemas import BRONZE_SCHEMA
from tests.helpers import document, epoch, raw_frame, rows, vector, write_file

FAILS = (PySparkException, Py4JJavaError)
T0 = epoch(2026, 7, 2, 12, 10)


def snapshot(t=T0, n=2):
    return document(t, [vector(30, 50) for _ in range(n)])


def landed(root, minutes=(0, 10, 20), dt="20260702"):
    for m in minutes:
        write_file(root, "global", dt, f"states_{T0 + m * 60}.json", snapshot(T0 + m * 60))


def test_raw_path_is_a_function_of_the_snapshot():
    assert raw.raw_path("global", 1782994208) == "region=global/dt=20260702/states_1782994208.json"


def test_compact_day(spark):
    assert spark.range(1).select(compact_day(F.lit(1782994208))).first()[0] == "20260702"


def test_reads_only_json_of_wanted_folders(spark, tmp_path):
    landed(tmp_path)
    landed(tmp_path, (0,), "20260703")
    write_file(tmp_path, "korea", "20260702", "states_1.json", snapshot())
    write_file(tmp_path, "global", "20260702", "notes.txt", "not a snapshot")
    found = raw.read_raw(spark, str(tmp_path), ["20260702"], ["global"])
    assert found.columns == ["value", "region", "dt"]
    assert rows(found, "region", "dt") == [("global", "20260702")] * 3
    assert raw.read_raw(spark, str(tmp_path)).count() == 5
    assert raw.read_raw(spark, str(tmp_path), ["20991231"]).count() == 0


def test_pretty_printed_file_is_one_document(spark, tmp_path):
    write_file(tmp_path, "global", "20260702", "a.json", '{\n "time": %d,\n "states": []\n}\n' % T0)
    assert bronze.to_bronze(raw.read_raw(spark, str(tmp_path))).count() == 1


def test_envelope(spark):
    row = bronze.to_bronze(raw_frame(spark, [snapshot()]), datetime(2026, 7, 3, 0, 5)).first()
    assert row.snapshot_time == datetime(2026, 7, 2, 12, 10)
    assert row._loaded_at == datetime(2026, 7, 3, 0, 5)
    assert (row.region, row.raw, row.dt) == ("global", snapshot(), date(2026, 7, 2))


BAD = ['{"time": 1782994208, "states": [[1', '{"states": []}', '{"time": "x"}', "", "nope", '{"time": null}', "[]",
       '[{"time": 1782994208, "states": []}]', '{"time": 1782994208} trailing']


@pytest.mark.parametrize("text", BAD)
def test_bad_document_fails_the_load(spark, text):
    with pytest.raises(FAILS):
        bronze.to_bronze(raw_frame(spark, [snapshot(), text])).collect()


def test_permissive_load_and_quarantine(spark):
    frame = raw_frame(spark, [snapshot(), *BAD])
    assert bronze.to_bronze(frame, mode="PERMISSIVE").count() == 1
    assert sorted(r.value for r in bronze.quarantine(frame).collect()) == sorted(BAD)


@pytest.mark.parametrize("states", ["null", "[]", None])
def test_snapshot_without_aircraft_is_a_bronze_row(spark, states):
    text = '{"time": %d}' % T0 if states is None else '{"time": %d, "states": %s}' % (T0, states)
    assert bronze.to_bronze(raw_frame(spark, [text])).count() == 1


def test_load_replaces_one_day_and_is_repeatable(spark, tmp_path):
    root, table = tmp_path / "raw", str(tmp_path / "bronze")
    landed(root)
    write_file(root, "global", "20260701", "a.json", snapshot(epoch(2026, 7, 1, 5)))
    for _ in range(2):
        bronze.load_days(spark, str(root), table, ["20260701", "20260702"])
        assert rows(bronze.read_bronze(spark, table).groupBy("dt").count()) == [
            (date(2026, 7, 1), 1), (date(2026, 7, 2), 3)]
    landed(root, (30,))
    bronze.load_days(spark, str(root), table, ["20260702"])
    assert rows(bronze.read_bronze(spark, table).groupBy("dt").count()) == [(date(2026, 7, 1), 1), (date(2026, 7, 2), 4)]
    assert bronze.read_bronze(spark, table, [date(2026, 7, 1)]).count() == 1


def test_failed_or_empty_load_keeps_the_stored_day(spark, tmp_path):
    root, table = tmp_path / "raw", str(tmp_path / "bronze")
    landed(root)
    bronze.load_days(spark, str(root), table, ["20260702"])
    bronze.load_days(spark, str(root), table, ["20260705"])  # no files
    write_file(root, "global", "20260702", "bad.json", "{")
    with pytest.raises(FAILS):
        bronze.load_days(spark, str(root), table, ["20260702"])
    assert bronze.read_bronze(spark, table).count() == 3


def test_row_of_another_day_is_refused(spark, tmp_path):
    root, table = tmp_path / "raw", str(tmp_path / "bronze")
    landed(root)
    bronze.load_days(spark, str(root), table, ["20260702"])
    write_file(root, "global", "20260703", "stray.json", snapshot(T0))
    with pytest.raises(PySparkException, match="2026-07-02 in a load of day 2026-07-03"):
        bronze.load_days(spark, str(root), table, ["20260703"])
    assert rows(bronze.read_bronze(spark, table).groupBy("dt").count()) == [(date(2026, 7, 2), 3)]
    one_day = bronze.to_bronze(raw_frame(spark, [snapshot()]))
    with pytest.raises(FAILS):
        bronze.write_bronze(one_day, table, date(2026, 7, 3))


def test_backfill_loads_a_range_in_one_job(spark, tmp_path):
    root, table = tmp_path / "raw", str(tmp_path / "bronze")
    for day in (1, 2, 4):
        write_file(root, "global", f"2026070{day}", "a.json", snapshot(epoch(2026, 7, day, 5)))
    bronze.backfill(spark, str(root), table, date(2026, 7, 1), date(2026, 7, 3))
    assert rows(bronze.read_bronze(spark, table), "dt") == [(date(2026, 7, 1),), (date(2026, 7, 2),)]


def test_resolve_dt():
    assert bronze.resolve_dt(datetime(2026, 7, 3, 0, 0)) == "20260702"
    assert bronze.resolve_dt(datetime(2026, 7, 3), override="20260601") == "20260601"


def test_packed_landing_keeps_the_last_copy_of_a_snapshot(spark, tmp_path):
    root = str(tmp_path / "raw")
    many = [("global", snapshot(T0, 1))] * 500 + [("global", snapshot(T0 + 600, 2))]
    raw.land_raw(spark.createDataFrame(many, "region STRING, value STRING"), root)
    newer = snapshot(T0, 3).replace(", ", ",\n ")
    raw.land_raw(spark.createDataFrame([("global", newer)], "region STRING, value STRING"), root)
    table = str(tmp_path / "bronze")
    bronze.load_days(spark, root, table, ["20260702"], pattern="*.txt", packed=True)
    sizes = bronze.read_bronze(spark, table).select(
        F.unix_seconds("snapshot_time"), F.size(F.from_json("raw", "states ARRAY<STRING>")["states"]))
    assert rows(sizes) == [(T0, 3), (T0 + 600, 2)]


def test_packed_landing_still_fails_on_bad_documents(spark, tmp_path):
    write_file(tmp_path, "global", "20260702", "a.txt", snapshot() + "\nbroken\n")
    with pytest.raises(FAILS):
        bronze.load_days(spark, str(tmp_path), str(tmp_path / "bronze"), ["20260702"], pattern="*.txt", packed=True)


def test_ingest_status(spark, tmp_path):
    landed(tmp_path)
    newest = max(p.stat().st_mtime for p in tmp_path.rglob("*.json"))
    import os

    for p in tmp_path.rglob("*.json"):
        os.utime(p, (newest, epoch(2026, 7, 2, 12, 0)))
    late = raw.ingest_status(spark, str(tmp_path), datetime(2026, 7, 2, 12, 21)).first()
    assert (late.files, late.lag_minutes, late.status) == (3, 21, "late")
    fine = raw.ingest_status(spark, str(tmp_path), datetime(2026, 7, 2, 12, 20, 59)).first()
    assert (fine.lag_minutes, fine.status) == (20, "ok")
    none = raw.ingest_status(spark, str(tmp_path), datetime(2026, 7, 9)).first()
    assert (none.files, none.newest, none.status) == (0, None, "no files")


def test_layer_name():
    assert layer_name("prod", None) == "default"
    assert layer_name("dev", None, "flights") == "flights"
    assert layer_name("prod", " marts ") == "marts"
    assert layer_name("dev", "marts") == "dev_marts"


def test_replace_days_empties_listed_days_without_rows(spark, tmp_path):
    path, days = str(tmp_path / "t"), [date(2026, 7, d) for d in (1, 2, 3)]
    frame = spark.createDataFrame([(1, days[0]), (2, days[1]), (3, days[2])], "n INT, dt DATE")
    write_days(frame, path)
    replace_days(frame.where("n = 2").withColumn("n", F.lit(9)), path, days[:2])
    assert rows(spark.read.parquet(path), "n", "dt") == [(3, days[2]), (9, days[1])]


def test_materialize_modes(spark, tmp_path):
    frame = spark.createDataFrame([(1, date(2026, 7, 1)), (2, date(2026, 7, 2))], "n INT, dt DATE")
    assert materialize(frame, "layer_view").count() == 2
    path = str(tmp_path / "layer")
    assert materialize(frame, "layer", "table", path=path).count() == 2
    again = materialize(frame.where("n = 1"), "layer", "table", path=path)
    assert rows(again, "n") == [(1,)]
    day = materialize(frame.where("n = 2"), "layer", "days", path=path, days=[date(2026, 7, 2)])
    assert rows(day, "n") == [(1,), (2,)]
    with pytest.raises(ValueError):
        materialize(frame, "layer", "other")


def test_bronze_schema_is_fixed(spark, tmp_path):
    assert bronze.read_bronze(spark, str(tmp_path / "none")).schema.simpleString() == spark.createDataFrame(
        [], BRONZE_SCHEMA).schema.simpleString()
