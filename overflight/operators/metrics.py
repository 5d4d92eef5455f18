"""Quality metrics in long format and their stored series."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from overflight.functions.timeparts import age_seconds, day_of, instant
from overflight.operators.completeness import lately, recent_days
from overflight.operators.density import latest_day
from overflight.schemas import METRIC_SCHEMA
from overflight.sources.storage import read_table

SNAPSHOTS, FRESHNESS, COVERAGE, DENSITY = "snapshot", "freshness", "coverage", "density"
QUERY_SUCCESS, LAST_SUCCESS = "query_success", "last_success"


def _long(df: DataFrame, kind: str, label, value) -> DataFrame:
    return df.select(F.lit(kind).alias("kind"), label.alias("label"), value.cast("double").alias("value"))


def metric_snapshots(bronze: DataFrame, as_of: datetime, days: int = 3) -> DataFrame:
    """Snapshots of a region per day, the current day included; counted in bronze or added up from its ledger."""
    window = recent_days(bronze, as_of, days)
    counted = F.sum("snapshots") if "snapshots" in bronze.columns else F.count_distinct("region", "snapshot_time")
    counts = window.groupBy(day_of(window).alias("dt")).agg(counted.alias("n"))
    return _long(counts, SNAPSHOTS, F.col("dt").cast("string"), F.col("n"))


def metric_freshness(bronze: DataFrame, as_of: datetime, days: int = 1) -> DataFrame:
    """Seconds since the last load; one row, NULL if nothing was loaded."""
    newest = recent_days(bronze, as_of, days).agg(F.max("_loaded_at").alias("newest"))
    return _long(newest, FRESHNESS, F.lit(""), age_seconds(as_of, "newest"))


def _latest_mean(mart: DataFrame, kind: str, column: str) -> DataFrame:
    day = mart if "dt" in mart.columns else mart.withColumn("dt", F.to_date("snapshot_time"))
    means = latest_day(day).groupBy("region").agg(F.avg(column).alias("mean"))
    return _long(means, kind, F.col("region"), F.col("mean"))


def metric_coverage(mart: DataFrame) -> DataFrame:
    """Mean coverage per region on the mart's latest day."""
    return _latest_mean(mart, COVERAGE, "coverage_pct")


def metric_density(mart: DataFrame) -> DataFrame:
    """Mean density per region on the mart's latest day."""
    return _latest_mean(mart, DENSITY, "density")


def quality_metrics(bronze: DataFrame, mart: DataFrame, as_of: datetime) -> DataFrame:
    """All metrics ``kind, label, value`` as one query. ``bronze`` may be its
    ledger, which knows the answers. ``mart`` should be the stored,
    day-partitioned table: two parts read its latest day."""
    mart = lately(mart, as_of)
    parts = [
        metric_snapshots(bronze, as_of),
        metric_freshness(bronze, as_of),
        metric_coverage(mart),
        metric_density(mart),
    ]
    return reduce(DataFrame.unionByName, parts)


def write_metrics(metrics: DataFrame, ts: datetime, root: str) -> None:
    """Store one tick below ``<root>/history``, in a folder of its own.

    Writing the same tick again replaces that folder, so a retry counts once
    and readers never find the table gone. NULL values are not written. A tick
    is one small file, so that stream readers see it as a whole.
    """
    at = instant(ts)
    tick = metrics.where(F.col("value").isNotNull()).select(
        at.alias("ts"), F.col("kind").alias("metric"), "label", "value",
        F.to_date(at).alias("dt"), F.unix_micros(at).alias("tick"),
    )
    (
        tick.coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt", "tick")
        .parquet(f"{root}/history")
    )


def read_history(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, f"{root}/history", METRIC_SCHEMA + ", dt DATE, tick BIGINT").drop("tick")


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """Of every metric the rows of its last tick. A metric that a failed
    refresh could not take keeps the values it had. Reads the values folded
    by ``fold_history`` and the ticks since, not all history."""
    upto, folded = _folded(spark, root)
    return _last_ticks(_since(spark, root, upto).unionByName(folded))


def _last_ticks(history: DataFrame) -> DataFrame:
    last = history.groupBy("metric").agg(F.max("ts").alias("ts"))
    return history.join(last, ["metric", "ts"], "left_semi").select("ts", "metric", "label", "value")


def _since(spark: SparkSession, root: str, day: date | None) -> DataFrame:
    history = read_history(spark, root)
    return (history if day is None else history.where(F.col("dt") >= F.lit(day))).drop("dt")


def _folded(spark: SparkSession, root: str) -> tuple[date | None, DataFrame]:
    """The day up to which (itself not included) ticks are folded, and the rows as of then."""
    row = read_table(spark, f"{root}/folds", "upto DATE").first()
    upto = None if row is None else row["upto"]
    return upto, read_table(spark, f"{root}/folded/upto={upto}", METRIC_SCHEMA)


def fold_history(spark: SparkSession, root: str, before: date) -> None:
    """Keep the current values as of the start of day ``before`` in one small
    table, so that ``read_current`` opens the ticks of later days only.

    For the days that have closed. History itself stays. The note of the fold
    is written last: a fold that dies, or is repeated, changes no result.
    """
    upto, folded = _folded(spark, root)
    if upto is not None and upto >= before:
        return
    ticks = read_history(spark, root).where(F.col("dt") < F.lit(before))
    ticks = ticks if upto is None else ticks.where(F.col("dt") >= F.lit(upto))
    _last_ticks(ticks.drop("dt").unionByName(folded)).coalesce(1).write.mode("overwrite").parquet(f"{root}/folded/upto={before}")
    spark.range(1).select(F.lit(before).alias("upto")).coalesce(1).write.mode("overwrite").parquet(f"{root}/folds")


def metric_min(series: DataFrame) -> DataFrame:
    """Lowest value over the labels, per tick and metric."""
    return series.groupBy("ts", "metric").agg(F.min("value").alias("value"))


def last_not_null(series: DataFrame) -> DataFrame:
    """Last known value of each (metric, label). A series has one value per tick."""
    known = series.where(F.col("value").isNotNull())
    return known.groupBy("metric", "label").agg(F.max("ts").alias("ts"), F.max_by("value", "ts").alias("value"))


def recent_series(series: DataFrame, metric: str, as_of: datetime, width: timedelta = timedelta(hours=24)) -> DataFrame:
    """Mean value per label and tick of one metric over the last ``width``."""
    start, end = instant(as_of - width), instant(as_of)
    window = series.where(F.col("metric") == metric).where(F.col("ts").between(start, end))
    if "dt" in series.columns:
        window = window.where(F.col("dt").between(F.to_date(start), F.to_date(end)))
    return window.groupBy("label", "ts").agg(F.avg("value").alias("value"))
