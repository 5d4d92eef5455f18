from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from overflight.operators import alerts, completeness, density, metrics, staging
from overflight.plans import pipeline
from overflight.sources import ledger, raw
from overflight.sources.bronze import load_days, read_bronze
from overflight.sources.reference import region_area
from overflight.streaming import aggregates, alert_jobs, arrivals, runs
from tests.helpers import document, epoch, rows, vector, write_file


def land(root, day, hour, minute, n=1, name="a"):
    t = epoch(2026, 7, day, hour, minute)
    write_file(root, "global", f"202607{day:02d}", f"{name}_{t}.json", document(t, [vector(30, 50)] * n))


def test_ingest_keeps_the_last_copy(spark, tmp_path):
    root, out, cp = str(tmp_path / "raw"), str(tmp_path / "out"), str(tmp_path / "cp")

    def run(*counts):
        docs = [("global", document(epoch(2026, 7, 1, 6, m), [vector(30, 50)] * n)) for m, n in counts]
        raw.land_raw(spark.createDataFrame(docs, "region STRING, value STRING"), root)
        arrivals.ingest(spark, root, out, cp, pattern="*.txt", packed=True)
        sizes = read_bronze(spark, out).select("snapshot_time", staging.state_count("raw").alias("n"))
        return [(t.minute, n) for t, n in rows(sizes)]

    assert run((0, 1), (10, 2)) == [(0, 1), (10, 2)]
    assert run((10, 5), (20, 1)) == [(0, 1), (10, 5), (20, 1)]


def test_ingest_of_one_region(spark, tmp_path):
    root, out = tmp_path / "raw", str(tmp_path / "out")
    for region in ("global", "korea"):
        write_file(root, region, "20260701", f"{region}.json", document(epoch(2026, 7, 1, 6, 0), []))
    arrivals.close_days(spark, str(root), out, str(tmp_path / "cp"), regions=["korea"])
    assert rows(read_bronze(spark, out), "region") == [("korea",)]


def test_closed_days_are_loaded_and_late_files_reload_them(spark, tmp_path):
    root, layout, cp = tmp_path / "raw", pipeline.Layout(str(tmp_path / "lake")), str(tmp_path / "cp")
    land(root, 1, 6, 0)
    land(root, 2, 6, 0)
    land(root, 3, 6, 0)

    def run(today=3):
        arrivals.apply_late(spark, str(root), layout, cp, before=date(2026, 7, today))
        return rows(read_bronze(spark, layout.bronze).groupBy("dt").count())

    assert run() == [(date(2026, 7, 1), 1), (date(2026, 7, 2), 1)]
    land(root, 1, 6, 30, n=4, name="late")
    assert run() == [(date(2026, 7, 1), 2), (date(2026, 7, 2), 1)]
    assert run() == [(date(2026, 7, 1), 2), (date(2026, 7, 2), 1)]
    # day 3 has closed: it is loaded although nothing new arrived
    assert run(today=4) == [(date(2026, 7, 1), 2), (date(2026, 7, 2), 1), (date(2026, 7, 3), 1)]
    mart = spark.read.parquet(layout.mart("region_density"))
    assert rows(mart, "snapshot_time", "aircraft_count") == [
        (datetime(2026, 7, 1, 6, 0), 1), (datetime(2026, 7, 1, 6, 30), 4), (datetime(2026, 7, 2, 6, 0), 1),
        (datetime(2026, 7, 3, 6, 0), 1)]


def bronze_table(spark, tmp_path, days=4):
    root, table = tmp_path / "raw", str(tmp_path / "bronze")
    for day in range(1, days + 1):
        for hour, minute in ((0, 0), (0, 1), (0, 10), (12, 30), (23, 50)):
            land(root, day, hour, minute, n=hour % 7 + 1)
    load_days(spark, str(root), table, [f"202607{d:02d}" for d in range(1, days + 1)])
    return table


def test_stream_equals_batch(spark, tmp_path):
    table = bronze_table(spark, tmp_path)
    staged = staging.stage(arrivals.stream_bronze(spark, table))
    batch = staging.stage(read_bronze(spark, table))
    out = str(tmp_path / "density")
    counted = aggregates.region_density(staged, region_area(spark))
    arrivals.run_available(counted.writeStream.outputMode("update").foreachBatch(runs.write_batch(out)), str(tmp_path / "c1"))
    schema = "snapshot_time TIMESTAMP, region STRING, aircraft_count BIGINT, area_sqdeg DOUBLE, density DOUBLE"
    latest = runs.read_latest(spark, out, ["snapshot_time", "region"], schema)
    expected = density.region_density(batch, region_area(spark))
    assert rows(latest) == rows(expected, "snapshot_time", "region", "aircraft_count", "area_sqdeg", "density")

    closed = aggregates.coverage(staged)
    cov = str(tmp_path / "coverage")
    arrivals.run_available(closed.writeStream.format("parquet").option("path", cov), str(tmp_path / "c2"))
    # the last day is still open: the watermark has not passed its end
    assert rows(spark.read.schema(closed.schema).parquet(cov)) == rows(
        density.daily_coverage(batch).where("dt < DATE '2026-07-04'"))


def test_frames(spark, tmp_path):
    table = bronze_table(spark, tmp_path, days=1)
    counted = aggregates.frames(staging.stage(arrivals.stream_bronze(spark, table)))
    out = str(tmp_path / "frames")
    arrivals.run_available(counted.writeStream.outputMode("update").foreachBatch(runs.write_batch(out)), str(tmp_path / "c"))
    got = runs.read_latest(spark, out, ["frame", "region"], "frame TIMESTAMP, region STRING, aircraft_count BIGINT")
    assert rows(got, "frame", "aircraft_count") == [
        (datetime(2026, 7, 1), 1), (datetime(2026, 7, 1, 12, 30), 6)]


def series(spark, held, start=0):
    data = [(datetime(2026, 7, 1) + timedelta(minutes=start + n), "m", label, float(h))
            for label, hs in held.items() for n, h in enumerate(hs)]
    return spark.createDataFrame(data, "ts TIMESTAMP, metric STRING, label STRING, value DOUBLE")


def test_alert_stream_continues_runs_and_ignores_replays(spark, tmp_path):
    held = {"x": [0, 1, 1, 1, 1, 1, 0, 0, 1, 1, 1, 0], "y": [1] * 12}
    rules = alerts.rule_table(spark, [alerts.Rule("a", "m", ">", 0, hold_s=180), alerts.Rule("b", "m", ">", 0, hold_s=60, over_labels=True)])
    whole = series(spark, held)
    source, path, cp = str(tmp_path / "series"), str(tmp_path / "alerts"), str(tmp_path / "cp")
    for lo, hi in ((0, 3), (3, 4), (4, 9), (9, 12)):
        cut = (F.col("ts") >= datetime(2026, 7, 1) + timedelta(minutes=lo)) & (F.col("ts") < datetime(2026, 7, 1) + timedelta(minutes=hi))
        whole.where(cut).coalesce(1).write.mode("append").parquet(source)
        arrivals.run_available(alert_jobs.alerts(alert_jobs.stream_series(spark, source), rules, path, max_gap_s=90), cp)
    columns = ("alert", "instance", "ts", "state", "active_since")
    expected = alerts.evaluate_alerts(whole, rules, max_gap_s=90).na.fill("")
    fill = lambda df: sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
    assert fill(alert_jobs.read_states(spark, path)) == fill(expected)
    # an instance silent in one batch keeps its state, a late sample is set aside
    series(spark, {"x": [1]}, start=2).write.mode("append").parquet(source)
    arrivals.run_available(alert_jobs.alerts(alert_jobs.stream_series(spark, source), rules, path), cp)
    assert rows(alert_jobs.read_late(spark, path), "alert", "instance", "value") == [("a", "x", 1.0), ("b", "", 1.0)]
    series(spark, {"y": [1]}, start=12).write.mode("append").parquet(source)
    arrivals.run_available(alert_jobs.alerts(alert_jobs.stream_series(spark, source), rules, path), cp)
    last = alert_jobs.read_states(spark, path).where("alert = 'a' AND instance = 'y'").orderBy(F.desc("ts")).first()
    assert (last.state, last.active_since) == ("firing", datetime(2026, 7, 1))


def test_metric_job_survives_failures(spark, tmp_path):
    layout = pipeline.Layout(str(tmp_path / "lake"))
    job = alert_jobs.metrics(spark, layout, every="1 second", clock=lambda: datetime(2026, 7, 4, 1, 30))
    query = job.option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        import time

        for _ in range(60):
            time.sleep(0.5)
            if (tmp_path / "lake" / "metrics" / "quality" / "history" / "_SUCCESS").exists():
                break
    finally:
        query.stop()
    stored = spark.read.parquet(layout.metrics + "/history")
    assert rows(stored.select("metric", "value").distinct()) == [("query_success", 0.0)]


def test_packed_files_keep_the_documents(spark, tmp_path):
    root = str(tmp_path / "raw")
    docs = [("global", document(epoch(2026, 7, 1, 6, m), [vector(30, 50)]).replace(",", ",\r\n")) for m in range(5)]
    raw.land_raw(spark.createDataFrame(docs, "region STRING, value STRING"), root)
    assert rows(raw.read_raw(spark, root, pattern="*.txt", wholetext=False), "region", "value") == sorted(docs)
    stream = raw.stream_raw(spark, root, pattern="*.txt", wholetext=False)
    out = str(tmp_path / "out")
    arrivals.run_available(stream.writeStream.format("parquet").option("path", out), str(tmp_path / "cp"))
    assert rows(spark.read.parquet(out), "region", "value") == sorted(docs)


def spoil(folder, *keep):
    """Make every data file unreadable that does not lie below one of these parts."""
    for file in folder.rglob("*.parquet"):
        if not any(part in str(file) for part in keep):
            file.write_bytes(b"no parquet")
            checksum = file.with_name(f".{file.name}.crc")
            if checksum.exists():
                checksum.unlink()


def test_a_batch_opens_only_the_pieces_it_touches(spark, tmp_path):
    root, out, cp = tmp_path / "raw", tmp_path / "bronze", str(tmp_path / "cp")
    for day in (1, 2):
        for hour in (5, 8, 12):
            land(root, day, hour, 0)
    arrivals.ingest(spark, str(root), str(out), cp)
    spoil(out, "dt=2026-07-02/region=global/hour=6")
    land(root, 2, 6, 10, n=3)
    arrivals.ingest(spark, str(root), str(out), cp)
    touched = spark.read.parquet(f"{out}/dt=2026-07-02/region=global/hour=6")
    assert rows(touched.select("snapshot_time", staging.state_count("raw").alias("n"))) == [
        (datetime(2026, 7, 2, 6, 10), 3), (datetime(2026, 7, 2, 8, 0), 1)]
    days = ledger.days(ledger.read_ledger(spark, str(out)))
    assert rows(days, "dt", "documents", "snapshots") == [(date(2026, 7, 1), 3, 3), (date(2026, 7, 2), 4, 4)]


def test_ingest_quarantines_and_survives_a_crash(spark, tmp_path, monkeypatch):
    root, out, cp = tmp_path / "raw", str(tmp_path / "bronze"), str(tmp_path / "cp")
    land(root, 1, 6, 0)
    write_file(root, "global", "20260701", "cut.json", '{"time": 17829')
    write_file(root, "global", "20260701", "stray.json", document(epoch(2026, 7, 2, 6, 0), []))
    arrivals.ingest(spark, str(root), out, cp)
    aside = spark.read.parquet(out + "-quarantine")
    assert rows(aside, "file", "folder") == [("cut.json", "20260701"), ("stray.json", "20260701")]
    land(root, 1, 6, 10)

    def crash(*_):
        (tmp_path / "bronze" / "dt=2026-07-01" / "region=global" / "hour=6").rename(tmp_path / "gone")  # half of a replacement
        raise RuntimeError("crash")

    with monkeypatch.context() as patch:
        patch.setattr(ledger, "record", crash)
        try:
            arrivals.ingest(spark, str(root), out, cp)
            raise AssertionError
        except Exception as failed:
            assert "crash" in str(failed)
    arrivals.ingest(spark, str(root), out, cp)
    assert rows(read_bronze(spark, out), "snapshot_time") == [(datetime(2026, 7, 1, 6, 0),), (datetime(2026, 7, 1, 6, 10),)]
    assert rows(ledger.days(ledger.read_ledger(spark, out)), "snapshots") == [(2,)]


def test_the_ledger_answers_without_the_table(spark, tmp_path):
    root, table = tmp_path / "raw", tmp_path / "bronze"
    for day in (1, 2, 4):
        land(root, day, 6, 0)
        land(root, day, 7, 10)
    load_days(spark, str(root), str(table), ["20260701", "20260702", "20260704"], loaded_at=datetime(2026, 7, 5))
    before = read_bronze(spark, str(table))
    as_of = datetime(2026, 7, 5, 12)
    ask = lambda df: (
        rows(completeness.freshness_status(df, as_of)), rows(completeness.missing_days(df, as_of, 5)),
        rows(completeness.incomplete_days(df, as_of, 5)), rows(metrics.metric_snapshots(df, as_of, 5)))
    expected = ask(before)
    spoil(table)
    assert ask(ledger.read_ledger(spark, str(table))) == expected


def test_silences_from_sessions(spark, tmp_path):
    start = datetime(2026, 7, 1)
    at = lambda *minutes: [start + timedelta(minutes=m) for m in minutes]
    signs = [("a", t) for t in at(0, 3, 8, 20, 40)] + [("b", t) for t in at(*range(0, 60, 5))] + [(None, t) for t in at(1, 30)]
    source, path, cp = str(tmp_path / "signs"), str(tmp_path / "sessions"), str(tmp_path / "cp")
    table = spark.createDataFrame(signs, "src STRING, ts TIMESTAMP")
    end = spark.createDataFrame([("clock", start + timedelta(days=1))], "src STRING, ts TIMESTAMP")
    for part in (table.where(F.minute("ts") < 15), table.where(F.minute("ts") >= 15), end):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema("src STRING, ts TIMESTAMP").parquet(source)
        arrivals.run_available(alert_jobs.heartbeat(stream, ["src"], path), cp)
    got = alert_jobs.read_silences(spark, path, "src STRING").where("next_seen IS NOT NULL")
    names = ("src", "last_seen", "down_at", "next_seen", "silent_seconds")
    key = lambda r: tuple(map(str, r))
    expected = alerts.heartbeat(table, ["src"])
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=key) == sorted(
        (tuple(r) for r in expected.select(*names).collect()), key=key) != []


def test_a_forgotten_alert_starts_anew(spark, tmp_path):
    rules = alerts.rule_table(spark, [alerts.Rule("a", "m", ">", 0, hold_s=60)])
    source, path, cp = str(tmp_path / "series"), str(tmp_path / "alerts"), str(tmp_path / "cp")
    parts = [series(spark, {"x": [1, 1]}), series(spark, {"y": [1]}, start=5000), series(spark, {"y": [1]}, start=5001),
             series(spark, {"x": [1]}, start=5002)]
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(source)
        job = alert_jobs.alerts(alert_jobs.stream_series(spark, source), rules, path, delay="1 minute", forget=timedelta(days=1))
        arrivals.run_available(job, cp)
    got = alert_jobs.read_states(spark, path).where("instance = 'x'").orderBy("ts")
    assert [r.state for r in got.collect()] == ["pending", "firing", "pending"]
