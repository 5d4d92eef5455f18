from datetime import datetime, timedelta

import pandas as pd

from overflight.operators import alerts
from overflight.operators.ordered import with_runs
from tests.helpers import rows

T = datetime(2026, 7, 10)
SERIES = "ts TIMESTAMP, metric STRING, label STRING, value DOUBLE"


def minutes(n):
    return T + timedelta(minutes=n)


def states(spark, held, hold_s=600, step=1, **options):
    """State per minute of a rule that holds where ``held`` is true."""
    data = [(minutes(n * step), "m", "", float(h)) for n, h in enumerate(held)]
    rule = alerts.Rule("a", "m", ">", 0, hold_s=hold_s, **options)
    return alerts.evaluate_alerts(spark.createDataFrame(data, SERIES), alerts.rule_table(spark, [rule]))


def sequence(df):
    return [r.state for r in df.orderBy("ts").collect()]


def test_nine_minutes_only_pend(spark):
    assert sequence(states(spark, [1] * 10)) == ["pending"] * 10


def test_ten_minutes_fire(spark):
    assert sequence(states(spark, [1] * 11)) == ["pending"] * 10 + ["firing"]


def test_a_false_sample_resets(spark):
    got = states(spark, [1] * 9 + [0] + [1] * 12).orderBy("ts").collect()
    assert [r.state for r in got] == ["pending"] * 9 + ["inactive"] + ["pending"] * 10 + ["firing"] * 2
    assert got[20].active_since == minutes(10)


def test_resolved_once(spark):
    assert sequence(states(spark, [1, 1, 1, 0, 0], hold_s=60)) == ["pending", "firing", "firing", "resolved", "inactive"]


def test_no_hold_time_fires_at_once(spark):
    assert sequence(states(spark, [0, 1, 0], hold_s=0)) == ["inactive", "firing", "resolved"]


def test_gap_resets_if_asked(spark):
    data = [(minutes(m), "m", "", 1.0) for m in (0, 1, 30, 31)]
    series = spark.createDataFrame(data, SERIES)
    rules = alerts.rule_table(spark, [alerts.Rule("a", "m", ">", 0, hold_s=60)])
    assert sequence(alerts.evaluate_alerts(series, rules)) == ["pending", "firing", "firing", "firing"]
    assert sequence(alerts.evaluate_alerts(series, rules, max_gap_s=300)) == ["pending", "firing", "pending", "firing"]


def test_rules_over_labels_take_the_lowest(spark):
    data = [(T, "coverage", "a", 0.9), (T, "coverage", "b", 0.7), (T, "snapshot", "x", 120.0), (T, "freshness", "", 172800.0)]
    got = alerts.evaluate_alerts(spark.createDataFrame(data, SERIES), alerts.rule_table(spark))
    assert rows(got, "alert", "instance", "value", "state") == [
        ("bronze_stale", "", 172800.0, "inactive"), ("low_coverage", "", 0.7, "pending"),
        ("snapshot_incomplete", "", 120.0, "inactive")]


def test_runs_equal_plain_windows_across_chunks(spark):
    """One key holds most rows; chunks of 1 to 1000 seconds cut its runs."""
    import random

    random.seed(3)
    data, t = [], 0
    for key, n in (("hot", 2000), ("cold", 40), (None, 30)):
        for _ in range(n):
            t += random.choice([1, 1, 1, 2, 7, 40])
            data.append((key, datetime.fromtimestamp(1_780_000_000 + t), random.random() < 0.7))
    frame = spark.createDataFrame(data, "k STRING, ts TIMESTAMP, holds BOOLEAN").repartition(7).persist()
    pdf = frame.toPandas().sort_values(["k", "ts"])
    pdf["k"] = pdf["k"].fillna("-")
    for gap in (None, 5):
        expected = []
        for key, group in pdf.groupby("k"):
            prev = prev_ts = since = None
            for ts, holds in zip(group.ts, group.holds):
                late = gap is not None and prev_ts is not None and (ts - prev_ts).total_seconds() > gap
                if holds and (not prev or late):
                    since = ts
                expected.append((key, ts, prev, prev_ts, since))
                prev, prev_ts = holds, ts
        for seconds in (1, 60, 1000, 86400):
            got = with_runs(frame, ["k"], "ts", "holds", gap, seconds).toPandas()
            got["k"] = got["k"].fillna("-")
            got = got.sort_values(["k", "ts"])[["k", "ts", "was_held", "prev_ts", "active_since"]]
            got = [tuple(None if pd.isna(v) else v for v in row) for row in got.itertuples(index=False)]
            assert got == expected


def told(df):
    return [(r.ts, r.instance, r.state) for r in alerts.state_changes(df).orderBy("ts", "instance").collect()]


def test_changes_of_a_run(spark):
    held = [0, 1, 1, 1, 0, 1, 0]
    assert told(states(spark, held, hold_s=0, step=5)) == [
        (minutes(5), "", "firing"), (minutes(20), "", "resolved"), (minutes(25), "", "firing"), (minutes(30), "", "resolved")]
    assert told(states(spark, [1] * 13, hold_s=0, step=60)) == [(T, "", "firing")]  # still firing
    assert told(states(spark, [1, 0, 1, 0], hold_s=600, step=5)) == []  # never held long enough


def test_changes_of_instances(spark):
    held = {"x": [1] * 20 + [0] * 20, "y": [0] * 7 + [1] * 20 + [0] * 13}
    data = [(minutes(n), "m", label, float(h)) for label, hs in held.items() for n, h in enumerate(hs)]
    rules = alerts.rule_table(spark, [alerts.Rule("a", "m", ">", 0, hold_s=0)])
    got = alerts.evaluate_alerts(spark.createDataFrame(data, SERIES), rules)
    assert told(got) == [(minutes(0), "x", "firing"), (minutes(7), "y", "firing"), (minutes(20), "x", "resolved"), (minutes(27), "y", "resolved")]


def test_routing_by_team(spark):
    other = states(spark, [1, 1], hold_s=0, team="someone-else")
    assert told(alerts.routed(other, "overflight")) == []
    assert len(told(alerts.routed(other, "someone-else"))) == 1


def test_alert_text(spark):
    data = [(T, "freshness", "", 176523.0)]
    got = alerts.alert_text(alerts.evaluate_alerts(spark.createDataFrame(data, SERIES), alerts.rule_table(spark))).first()
    assert got.title == "CRITICAL | bronze_stale"
    assert got.text == "no bronze load for 48 h (value 2d 1h 2m 3s)"


def test_heartbeat(spark):
    data = [("a", minutes(m)) for m in (0, 1, 6, 12, 13)] + [("b", minutes(m)) for m in (0, 0, 5)]
    beats = spark.createDataFrame(data, "src STRING, ts TIMESTAMP")
    got = alerts.heartbeat(beats, ["src"], as_of=minutes(16))
    found = [(r.src, r.last_seen, r.down_at, r.next_seen, r.silent_seconds) for r in got.orderBy("last_seen").collect()]
    assert found == [("b", minutes(5), minutes(10), None, 660), ("a", minutes(6), minutes(11), minutes(12), 360)]
    assert alerts.heartbeat(beats, ["src"]).count() == 1


def test_heartbeat_equals_brute_force_with_a_hot_source(spark):
    import random

    random.seed(5)
    data = [("hot", datetime.fromtimestamp(1_780_000_000 + random.random() * 40_000)) for _ in range(3000)]
    data += [(f"s{n % 5}", datetime.fromtimestamp(1_780_000_000 + random.random() * 40_000)) for n in range(400)]
    beats = spark.createDataFrame(data, "src STRING, ts TIMESTAMP").repartition(6)
    expected = []
    for src in {s for s, _ in data}:
        seen = sorted(t for s, t in data if s == src)
        expected += [(src, a, b) for a, b in zip(seen, seen[1:]) if b - a > timedelta(seconds=60)]
    got = rows(alerts.heartbeat(beats, ["src"], silent_s=60), "src", "last_seen", "next_seen")
    assert got == sorted(expected) and len(got) > 300


def test_classify_failures(spark):
    data = [("bronze_x.source", "e" * 900), ("bronze_x.test", None), ("stg.test", "short"), ("load", "x" * 800)]
    frame = spark.createDataFrame(data, "task_id STRING, error STRING")
    got = {r.task_id: (r.failure_kind, r.blocks_downstream, r.error) for r in alerts.classify_failures(frame, "bronze_x").collect()}
    assert got["bronze_x.source"][:2] == ("freshness", True) and got["bronze_x.source"][2] == "e" * 800 + " …(생략)"
    assert got["bronze_x.test"] == ("volume", True, None)
    assert got["stg.test"] == ("failure", False, "short") and got["load"][2] == "x" * 800
