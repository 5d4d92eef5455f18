"""Alert states, silences and metric refresh as running jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from overflight.operators.alerts import HEARTBEAT_S, holding
from overflight.operators.ordered import with_next
from overflight.plans.pipeline import Layout, refresh_metrics
from overflight.schemas import METRIC_SCHEMA
from overflight.sources.storage import read_table
from overflight.streaming.runs import latest_run, write_batch

STATE_SCHEMA = (
    "alert STRING, instance STRING, ts TIMESTAMP, hold_s BIGINT, severity STRING, team STRING, summary STRING, "
    "value DOUBLE, active_since TIMESTAMP, state STRING"
)
LATE = "late"
SECOND = 1_000_000


def stream_series(spark: SparkSession, path: str, max_ticks: int = 1000) -> DataFrame:
    """Stored metric ticks as a stream, at most ``max_ticks`` files a batch. A tick must be one file."""
    return spark.readStream.schema(METRIC_SCHEMA).option("maxFilesPerTrigger", max_ticks).parquet(path)


JUDGED = Row("alert", "instance", "at", "hold_s", "severity", "team", "summary", "value", "since", "state")


class AlertStates(StatefulProcessor):
    """The state machine of one (alert, instance): inactive, pending, firing, resolved.

    Times are microseconds. State is the last judged sample and the start of
    the current or last run of true samples. The samples of a batch are
    combined by tick and judged in time order, so a batch holds one value per
    tick. A sample that is not later than the last judged one cannot change
    what was sent: it comes out as ``late`` and changes nothing. An event-time
    timer forgets an instance that has been silent for ``forget``.
    """

    OUTPUT = ("alert STRING, instance STRING, at BIGINT, hold_s BIGINT, severity STRING, team STRING, summary STRING, "
              "value DOUBLE, since BIGINT, state STRING")

    def __init__(self, max_gap_s: int | None, forget: timedelta):
        self.max_gap_s, self.forget_ms = max_gap_s, int(forget.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at BIGINT, holds BOOLEAN, since BIGINT, timer BIGINT")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        ticks: dict[int, Row] = {}
        for row in rows:
            if row.at not in ticks or row.value < ticks[row.at].value:
                ticks[row.at] = row
        known = self.last.get()
        last, was_held, since, timer = known if known is not None else (None, False, None, None)
        judged = last
        for at, row in sorted(ticks.items()):
            facts = (*key, at, row.hold_s, row.severity, row.team, row.summary, row.value)
            if judged is not None and at <= judged:
                yield JUDGED(*facts, None, LATE)
                continue
            gap = self.max_gap_s is not None and judged is not None and (at - judged) // SECOND > self.max_gap_s
            fired = was_held and (judged - since) // SECOND >= row.hold_s
            if row.holds and (gap or not was_held):
                since = at
            if row.holds:
                state = "firing" if (at - since) // SECOND >= row.hold_s else "pending"
            else:
                state = "resolved" if fired else "inactive"
            yield JUDGED(*facts, since, state)
            judged, was_held = at, row.holds
        if judged != last:
            if timer is not None:
                self.handle.deleteTimer(timer)
            timer = judged // 1000 + self.forget_ms
            self.handle.registerTimer(timer)
            self.last.update((judged, was_held, since, timer))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.last.clear()
        return iter([])

    def close(self) -> None:
        pass


def alerts(
    series: DataFrame, rules: DataFrame, path: str, max_gap_s: int | None = None, delay: str = "7 days",
    forget: timedelta = timedelta(days=30),
) -> DataStreamWriter:
    """Alert states of new ticks as they come, with state kept by the engine per alert instance.

    The state store and the checkpoint carry on what the last batch knew, also
    after a restart. Samples that are late by more than ``delay`` are dropped
    and counted by the engine; others are set aside as late. A new checkpoint
    evaluates the series from its start, as a run of its own below ``path``.
    """
    samples = holding(series.withWatermark("ts", delay).where(F.col("value").isNotNull()).join(rules, "metric"))
    samples = samples.withColumn("at", F.unix_micros("ts"))
    states = samples.groupBy("alert", "instance").transformWithState(
        AlertStates(max_gap_s, forget), AlertStates.OUTPUT, "append", "eventtime")
    instants = {"ts": F.timestamp_micros("at"), "active_since": F.timestamp_micros("since")}
    states = states.withColumns(instants).select(*[field.split()[0] for field in STATE_SCHEMA.split(", ")])
    return states.writeStream.foreachBatch(write_batch(path))


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """The states of the newest run."""
    return latest_run(spark, path, STATE_SCHEMA).where(F.col("state") != LATE)


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """Samples of the newest run that came after a later one had been judged."""
    return latest_run(spark, path, STATE_SCHEMA).where(F.col("state") == LATE).drop("state", "active_since")


def heartbeat(
    series: DataFrame, keys: Sequence[str], path: str, ts: str = "ts", silent_s: int = HEARTBEAT_S, delay: str = "1 hour"
) -> DataStreamWriter:
    """Sessions of signs per source: ``first_seen, last_seen, signs``, once a silence has ended them.

    A session is a time without a silence longer than ``silent_s``; it comes
    out when the watermark is past its last sign by that much. State is one row
    per open session, whatever the length of a source's history. Signs of a
    batch are merged where they are read, before they meet those of other
    tasks, so a source that sends most of them is as small as any other.
    """
    spark = series.sparkSession
    spark.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    gap = F.session_window(F.col(ts), f"{silent_s} seconds")
    sessions = (
        series.withWatermark(ts, delay).groupBy(gap.alias("w"), *keys)
        .agg(F.count("*").alias("signs"))
        .select(*keys, F.col("w.start").alias("first_seen"),
                (F.col("w.end") - F.make_dt_interval(secs=F.lit(silent_s))).alias("last_seen"), "signs")
    )
    return sessions.writeStream.outputMode("append").foreachBatch(write_batch(path))


def read_silences(spark: SparkSession, path: str, keys: str, silent_s: int = HEARTBEAT_S) -> DataFrame:
    """Silences that closed sessions tell of, as ``heartbeat`` of the batch operators gives them.

    ``keys`` is a schema string. ``next_seen`` is the next closed session of
    the source; while that one is still open, it is NULL, and so is the length.
    """
    names = [field.split()[0] for field in keys.split(", ")]
    sessions = latest_run(spark, path, f"{keys}, first_seen TIMESTAMP, last_seen TIMESTAMP, signs BIGINT")
    gaps = with_next(sessions, names, "first_seen", "first_seen", "next_seen")
    return gaps.select(
        *names, "last_seen", (F.col("last_seen") + F.make_dt_interval(secs=F.lit(silent_s))).alias("down_at"), "next_seen",
        F.floor(F.timestamp_diff("MICROSECOND", F.col("last_seen"), F.col("next_seen")) / 1_000_000).cast("bigint").alias("silent_seconds"),
    )


def metrics(spark: SparkSession, layout: Layout, every: str = "300 seconds",
            clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc)) -> DataStreamWriter:
    """Refresh the metric table at a fixed pace, apart from whoever reads it.
    A refresh that fails is recorded and the job goes on."""

    def refresh(_batch: DataFrame, _batch_id: int) -> None:
        refresh_metrics(spark, layout, clock())

    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return ticks.writeStream.foreachBatch(refresh).trigger(processingTime=every)
