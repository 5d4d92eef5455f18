"""Alert rules over metric series: hold times, notifications, heartbeats, failures."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from overflight.functions.text import clip_text
from overflight.functions.timeparts import humanize_duration, instant
from overflight.operators.metrics import COVERAGE, FRESHNESS, QUERY_SUCCESS, SNAPSHOTS
from overflight.sources.reference import literal_table
from overflight.operators.ordered import with_next, with_runs


@dataclass(frozen=True)
class Rule:
    """``metric op threshold`` must hold for ``hold_s`` seconds.

    ``over_labels`` compares the lowest value over all labels; otherwise every
    label is an alert instance of its own.
    """

    alert: str
    metric: str
    op: str
    threshold: float
    hold_s: int = 600
    severity: str = "warning"
    team: str = "overflight"
    over_labels: bool = False
    summary: str = ""


# The rules.
DEFAULT_RULES = (
    Rule("bronze_stale", FRESHNESS, ">", 172800, severity="critical", summary="no bronze load for 48 h"),
    Rule("metrics_query_failed", QUERY_SUCCESS, "==", 0, summary="metrics are not being refreshed"),
    Rule("snapshot_incomplete", SNAPSHOTS, "<", 115, over_labels=True, summary="a day has fewer than 115 snapshots"),
    Rule("low_coverage", COVERAGE, "<", 0.8, over_labels=True, summary="a region's coverage is below 0.8"),
)
HEARTBEAT_S = 300
CHUNK_BUCKETS = 10_000

RULE_SCHEMA = (
    "alert STRING, metric STRING, op STRING, threshold DOUBLE, hold_s BIGINT, severity STRING, team STRING, "
    "over_labels BOOLEAN, summary STRING"
)


def rule_table(spark: SparkSession, rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    rows = [
        (r.alert, r.metric, r.op, float(r.threshold), r.hold_s, r.severity, r.team, r.over_labels, r.summary)
        for r in rules
    ]
    return literal_table(spark, rows, RULE_SCHEMA)


def _holds(value: Column, op: Column, threshold: Column) -> Column:
    return (
        F.when(op == ">", value > threshold)
        .when(op == ">=", value >= threshold)
        .when(op == "<", value < threshold)
        .when(op == "<=", value <= threshold)
        .when(op == "==", value == threshold)
        .when(op == "!=", value != threshold)
    )


def rule_samples(series: DataFrame, rules: DataFrame) -> DataFrame:
    """The value each rule looks at, per instance and tick, and whether its
    condition holds. ``rules`` is joined by its known small size; aggregation
    over the labels combines on the map side."""
    instance = F.when(F.col("over_labels"), F.lit("")).otherwise(F.col("label"))
    return holding(
        series.where(F.col("value").isNotNull())
        .join(rules, "metric")
        .groupBy("alert", instance.alias("instance"), "ts", "op", "threshold", "hold_s", "severity", "team", "summary")
        .agg(F.min("value").alias("value"))
    )


def holding(samples: DataFrame) -> DataFrame:
    """Samples of rules with ``holds`` instead of operator and threshold, and
    with their ``instance``, if the labels are still there."""
    if "label" in samples.columns:
        samples = samples.withColumn("instance", F.when(F.col("over_labels"), F.lit("")).otherwise(F.col("label")))
    held = _holds(F.col("value"), F.col("op"), F.col("threshold"))
    return samples.withColumn("holds", held).drop("op", "threshold", "label", "over_labels", "metric")


def alert_states(samples: DataFrame, max_gap_s: int | None = None) -> DataFrame:
    """State per sample: inactive, pending, firing or (once) resolved.

    The condition has to hold at every sample for ``hold_s`` seconds before the
    alert fires; a false sample resets, and so does a gap above ``max_gap_s``.
    ``active_since`` is the start of the current or last run of true samples.
    A sample may bring its ``active_since`` in a column ``since``, if the
    samples before it are not at hand.
    """
    return _states(with_runs(samples, ["alert", "instance"], "ts", "holds", max_gap_s))


def _seconds(start: str, end: str) -> Column:
    return F.timestamp_diff("SECOND", F.col(start), F.col(end))


def _states(runs: DataFrame) -> DataFrame:
    fired_before = F.coalesce(F.col("was_held"), F.lit(False)) & (_seconds("active_since", "prev_ts") >= F.col("hold_s"))
    state = (
        F.when(F.col("holds") & (_seconds("active_since", "ts") >= F.col("hold_s")), "firing")
        .when(F.col("holds"), "pending")
        .when(fired_before, "resolved")
        .otherwise("inactive")
    )
    return runs.withColumn("state", state).drop("holds", "was_held", "prev_ts", "since")


def evaluate_alerts(series: DataFrame, rules: DataFrame, max_gap_s: int | None = None) -> DataFrame:
    """Alert state per rule instance and tick of the series."""
    return alert_states(rule_samples(series, rules), max_gap_s)


def alert_text(states: DataFrame) -> DataFrame:
    """Title and text of an alert row. The value of a rule on the freshness
    metric is a number of seconds and is shown as a duration."""
    seconds = F.col("alert").isin([r.alert for r in DEFAULT_RULES if r.metric == FRESHNESS])
    shown = F.when(seconds, humanize_duration("value")).otherwise(F.round("value", 3).cast("string"))
    return states.withColumn("title", F.concat_ws(" | ", F.upper("severity"), "alert")).withColumn(
        "text", F.format_string("%s (value %s)", "summary", shown)
    )


def routed(states: DataFrame, team: str) -> DataFrame:
    """The alerts that go to one team."""
    return states.where(F.col("team") == team)


def state_changes(states: DataFrame) -> DataFrame:
    """Starts and ends of firing, one row each, with title and text: what there
    is to tell somebody. When and how often it is told is not decided here.

    A run of firing is known by the instance and ``active_since``; aggregation
    by run combines on the map side.
    """
    runs = (
        states.where(F.col("state").isin("firing", "resolved"))
        .groupBy("alert", "instance", "severity", "team", "summary", "active_since")
        .agg(
            F.min(F.when(F.col("state") == "firing", F.struct("ts", "value"))).alias("firing"),
            F.min(F.when(F.col("state") == "resolved", F.struct("ts", "value"))).alias("resolved"),
        )
    )
    edge = F.array_compact(F.array(*[
        F.when(F.col(kind).isNotNull(), F.struct(F.lit(kind).alias("state"), F.col(f"{kind}.ts").alias("ts"), F.col(f"{kind}.value").alias("value")))
        for kind in ("firing", "resolved")
    ]))
    edges = runs.withColumn("edge", F.explode(edge)).drop("firing", "resolved")
    return alert_text(edges.select("*", "edge.*").drop("edge"))


def heartbeat(
    series: DataFrame, keys: Sequence[str], ts: str = "ts", silent_s: int = HEARTBEAT_S, as_of: datetime | None = None
) -> DataFrame:
    """Silences longer than ``silent_s`` per source: last sign of life, when it
    counts as down, and the next sign (NULL while it is still silent at ``as_of``).

    Inside a bucket of ``silent_s`` seconds no silence can be that long, so
    first and last sign per bucket are enough. That aggregate combines on the
    map side: a source that sends most of the rows is as small as any other.
    The next sign is looked up in pieces of ``CHUNK_BUCKETS`` buckets, so the
    history of a source is never one task's work.
    """
    bucket = F.floor(F.unix_micros(ts) / (silent_s * 1_000_000)).cast("bigint").alias("_bucket")
    signs = series.groupBy(*keys, bucket).agg(F.min(ts).alias("_first"), F.max(ts).alias("last_seen"))
    gaps = with_next(signs, keys, "last_seen", "_first", "next_seen", CHUNK_BUCKETS * silent_s)
    end = F.col("next_seen") if as_of is None else F.coalesce(F.col("next_seen"), instant(as_of))
    silence = F.timestamp_diff("MICROSECOND", F.col("last_seen"), end)
    return gaps.where(silence > silent_s * 1_000_000).select(
        *keys,
        "last_seen",
        (F.col("last_seen") + F.make_dt_interval(secs=F.lit(silent_s))).alias("down_at"),
        "next_seen",
        F.floor(silence / 1_000_000).cast("bigint").alias("silent_seconds"),
    )


def classify_failures(
    events: DataFrame, gate_prefix: str, source_suffix: str = ".source", limit: int = 800
) -> DataFrame:
    """Sort task failures ``task_id, error`` into gates and plain failures.

    A task of the gate prefix is the freshness gate if it ends in
    ``source_suffix``, else the volume gate.
    """
    gate = F.col("task_id").startswith(gate_prefix)
    kind = F.when(gate & F.col("task_id").endswith(source_suffix), "freshness").when(gate, "volume").otherwise("failure")
    return events.withColumn("failure_kind", kind).withColumn("blocks_downstream", gate).withColumn(
        "error", clip_text("error", limit)
    )
