from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from overflight.operators import completeness, metrics, quality
from tests.helpers import rows

D = datetime(2026, 7, 10, 9, 0)
DAY = D.date()


@pytest.fixture(scope="module")
def bronze(spark):
    """d-4: 144, d-3: 114, d-2: 115, d-1: none, d: 10 snapshots."""
    counts = {4: 144, 3: 114, 2: 115, 0: 10}
    data = [
        (datetime(DAY.year, DAY.month, DAY.day) - timedelta(days=back) + timedelta(minutes=10 * n),)
        for back, n_rows in counts.items() for n in range(n_rows)
    ]
    frame = spark.createDataFrame(data, "snapshot_time TIMESTAMP")
    return frame.withColumn("_loaded_at", F.lit(D - timedelta(hours=9))).withColumn(
        "dt", F.to_date("snapshot_time")).withColumn("region", F.lit("global")).persist()


def back(n):
    return DAY - timedelta(days=n)


def test_incomplete_days(bronze):
    few = completeness.incomplete_days(bronze, D, 3, 115)
    assert rows(few) == [(back(3), 114)]
    assert rows(completeness.completeness_message(few, 115)) == [(f"{back(3)}=114/115",)]
    many = completeness.incomplete_days(bronze, D, 4, 145)
    assert rows(completeness.completeness_message(many, 145)) == [(f"{back(4)}=144/145, {back(3)}=114/145, {back(2)}=115/145",)]
    assert completeness.completeness_message(completeness.incomplete_days(bronze, D, 3, 1)).count() == 0


def test_a_snapshot_in_pieces_counts_once(bronze):
    pieces = bronze.unionByName(bronze.where("minute(snapshot_time) < 30"))
    assert rows(completeness.incomplete_days(pieces, D, 4, 145)) == rows(completeness.incomplete_days(bronze, D, 4, 145))
    assert rows(metrics.metric_snapshots(pieces, D, 3)) == rows(metrics.metric_snapshots(bronze, D, 3))
    two = bronze.unionByName(bronze.withColumn("region", F.lit("other")))
    assert rows(completeness.incomplete_days(two, D, 3, 300)) == [(back(3), 228), (back(2), 230)]


def test_missing_days(bronze):
    assert rows(completeness.missing_days(bronze, D, 3)) == [(back(1),)]
    assert completeness.missing_days(bronze.drop("dt"), D, 5).count() == 2


def test_daily_health(bronze):
    assert rows(completeness.daily_health(bronze, D, 7, 144)) == [
        (back(4), 144, "ok"), (back(3), 114, "missing data"), (back(2), 115, "missing data"), (DAY, 10, "excluded")]


def test_metric_snapshots_include_today(bronze):
    assert rows(metrics.metric_snapshots(bronze, D, 3), "label", "value") == [
        (str(back(3)), 114.0), (str(back(2)), 115.0), (str(DAY), 10.0)]


@pytest.mark.parametrize("age, status", [(36 * 3600, "pass"), (36 * 3600 + 1, "warn"), (48 * 3600, "warn"), (48 * 3600 + 1, "error")])
def test_freshness(bronze, age, status):
    at = D - timedelta(hours=9) + timedelta(seconds=age)
    row = completeness.freshness_status(bronze, at).first()
    assert (row.age_seconds, row.status) == (age, status)


def test_freshness_of_nothing(bronze):
    nothing = bronze.where("false")
    assert completeness.freshness_status(nothing, D).first().status == "error"
    assert rows(metrics.metric_freshness(nothing, D)) == [("freshness", "", None)]


@pytest.mark.parametrize("at, status", [
    (datetime(2026, 7, 9, 0, 30), "ok"), (datetime(2026, 7, 9, 1, 5), "ok"), (datetime(2026, 7, 10, 1, 4), "ok"),
    (datetime(2026, 7, 10, 1, 5), "stale"), (datetime(2026, 7, 8, 9), "stale")])
def test_mart_freshness(spark, at, status):
    mart = spark.createDataFrame([(datetime(2026, 7, 8, 23, 50),)], "snapshot_time TIMESTAMP")
    assert completeness.mart_freshness(mart, at).first().status == status


def test_mart_freshness_of_an_empty_mart(spark):
    assert completeness.mart_freshness(spark.createDataFrame([], "snapshot_time TIMESTAMP"), D).first().status == "empty"


def test_verdict_runs_every_check(spark, bronze):
    mart = spark.createDataFrame([(datetime(2026, 7, 9, 23, 50),)], "snapshot_time TIMESTAMP")
    checks = completeness.health_checks(bronze, mart, D)
    assert rows(checks) == [("daily_snapshots", 2), ("mart_freshness", 0), ("yesterday_loaded", 1)]
    assert rows(completeness.health_verdict(checks)) == [(1, 3, 2)]
    late = spark.createDataFrame([("late",)], "status STRING")
    with_ingest = completeness.health_checks(bronze, mart, D, ingest=late)
    assert rows(with_ingest.where("check_name = 'ingest'")) == [("ingest", 1)]
    fine = completeness.health_checks(bronze.where(F.col("dt") == back(4)), mart, datetime(2026, 7, 7, 9), days=2)
    assert rows(completeness.health_verdict(fine.where("check_name != 'mart_freshness'"))) == [(0, 2, 0)]


def one(spark, values, dtype, check):
    frame = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return quality.run_checks(frame, [check]).first()


def test_check_semantics(spark):
    assert one(spark, [None, 0, 5, -1], "INT", quality.accepted_range("x", 0, 5)).failing_rows == 1
    assert one(spark, [None, 0, 5, -1], "INT", quality.accepted_range("x", high=4)).failing_rows == 1
    assert one(spark, [None, "a", "z"], "STRING", quality.accepted_values("x", ["a"])).failing_rows == 1
    assert one(spark, ["a", "a", None, None], "STRING", quality.unique("x")).failing_rows == 1
    assert one(spark, [None, 1], "INT", quality.not_null("x")).failing_rows == 1
    warned = one(spark, [None], "INT", quality.not_null("x", severity="warn"))
    assert (warned.failing_rows, warned.status) == (1, "warn")
    assert one(spark, [1], "INT", quality.not_null("x")).status == "pass"
    assert one(spark, [], "INT", quality.not_null("x")).status == "pass"


def test_scope_limits_a_check(spark):
    frame = spark.createDataFrame([(505.5, 3), (505.5, None), (90.0, 0), (361.0, 0)], "track DOUBLE, src INT")
    check = quality.accepted_range("track", 0, 360, where="src = 0")
    assert quality.run_checks(frame, [check]).first().failing_rows == 1
    assert rows(quality.failing_rows(frame, check), "track") == [(361.0,)]


def test_declared_checks_are_complete():
    kinds = [c.kind for checks in quality.declared_checks().values() for c in checks]
    assert {k: kinds.count(k) for k in set(kinds)} == {"not_null": 25, "unique": 1, "accepted_values": 6, "accepted_range": 16}


def test_checks_of_a_relation_share_one_scan(spark, tmp_path):
    spark.range(10).selectExpr("id", "id AS x", "id AS unused").write.parquet(str(tmp_path / "t"))
    frame = spark.read.parquet(str(tmp_path / "t"))
    checks = [quality.not_null("id"), quality.accepted_range("x", 0), quality.accepted_range("x", None, 5)]
    results = quality.run_checks(frame, checks)
    plan = results._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "unused" not in plan.split("ReadSchema")[1]


def test_gates(spark):
    frame = spark.createDataFrame([(None,), (1,)], "x INT")
    warn = quality.run_checks(frame, [quality.not_null("x", severity="warn")], "t")
    assert [r.status for r in quality.run_gates([warn])] == ["warn"]
    with pytest.raises(quality.GateError, match=r"t.not_null\(x\): 1"):
        quality.run_gates([warn, quality.run_checks(frame, [quality.not_null("x")], "t")])


def test_singular_check(spark):
    frame = spark.createDataFrame([(1,), (2,)], "x INT")
    row = quality.run_singular(quality.Singular("big", lambda: frame.where("x > 1"), "warn"), "t").first()
    assert (row.check_name, row.failing_rows, row.status) == ("big", 1, "warn")


@pytest.fixture(scope="module")
def mart(spark):
    data = [(date(2026, 7, 8), "ukraine", 9.0, 9.0), (date(2026, 7, 9), "ukraine", 1.0, 0.5),
            (date(2026, 7, 9), "ukraine", 0.5, 1.5), (date(2026, 7, 9), "west_europe", 1.0, 7.0)]
    return spark.createDataFrame(data, "dt DATE, region STRING, coverage_pct DOUBLE, density DOUBLE")


def test_metrics_of_the_latest_day(bronze, mart):
    taken = metrics.quality_metrics(bronze, mart, D)
    assert rows(taken.where("kind IN ('coverage', 'density')")) == [
        ("coverage", "ukraine", 0.75), ("coverage", "west_europe", 1.0), ("density", "ukraine", 1.0), ("density", "west_europe", 7.0)]
    assert rows(taken.where("kind = 'freshness'"), "value") == [(9 * 3600.0,)]


def test_ticks_are_kept_and_replaced(spark, bronze, mart, tmp_path):
    root = str(tmp_path / "metrics")
    for _ in range(2):  # a retried tick counts once
        metrics.write_metrics(metrics.quality_metrics(bronze, mart, D), D, root)
    later = D + timedelta(days=3)
    metrics.write_metrics(metrics.quality_metrics(bronze, mart, later), later, root)
    current = metrics.read_current(spark, root)
    # freshness is NULL by then (no load within a day) and is not written: the last known value stays
    assert rows(current.where("metric = 'snapshot'"), "ts", "label") == [(later, str(DAY))]
    assert rows(current.where("metric = 'freshness'"), "ts", "value") == [(D, 9 * 3600.0)]
    assert metrics.read_history(spark, root).count() == (3 + 1 + 2 + 2) + (1 + 2 + 2)
    assert len(spark.read.parquet(root + "/history").inputFiles()) == 2


def test_series_reads(spark):
    t = datetime(2026, 7, 10)
    data = [(t, "coverage", "a", 0.5), (t, "coverage", "b", 0.7), (t + timedelta(hours=1), "coverage", "a", None),
            (t - timedelta(hours=30), "coverage", "a", 0.1)]
    series = spark.createDataFrame(data, "ts TIMESTAMP, metric STRING, label STRING, value DOUBLE")
    assert rows(metrics.metric_min(series.where(F.col("ts") == t)), "value") == [(0.5,)]
    assert rows(metrics.last_not_null(series), "label", "value") == [("a", 0.5), ("b", 0.7)]
    assert rows(metrics.recent_series(series, "coverage", t), "label", "value") == [("a", 0.5), ("b", 0.7)]
