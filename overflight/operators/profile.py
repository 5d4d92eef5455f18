"""What each position source looks like, and since when it reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from overflight.functions.timeparts import day_of


def exact_median(df: DataFrame, key: str, values: Sequence[str], accuracy: int = 10_000) -> DataFrame:
    """``key, metric, median`` with the exact median of each value column.

    No group is gathered whole. A mergeable quantile sketch first brackets the
    median; then everything below the bracket is only counted, the few values
    inside are counted per value, and a running count over these picks the
    middle one or two. The sketch's rank error is at most rows/accuracy, the
    bracket is twice that wide on each side, so the median is always inside;
    the query fails if it should not be.
    """
    long = df.select(key, *values).unpivot(key, list(values), "metric", "value").where(F.col("value").isNotNull())
    margin = 2.0 / accuracy
    sketch = F.percentile_approx("value", [0.5 - margin, 0.5 + margin], accuracy)
    brackets = (
        long.groupBy(key, "metric")
        .agg(sketch.alias("_b"), F.count("*").alias("_n"))
        .select(
            F.col(key).alias("_key"),
            F.col("metric").alias("_metric"),
            F.col("_b")[0].alias("_lo"),
            F.col("_b")[1].alias("_hi"),
            "_n",
        )
    )
    bracketed = long.join(brackets, (F.col("metric") == F.col("_metric")) & F.col(key).eqNullSafe(F.col("_key")))
    low = F.col("value") < F.col("_lo")
    counts = (
        bracketed.where(F.col("value") <= F.col("_hi"))
        .groupBy(key, "metric", "_n", F.when(~low, F.col("value")).alias("value"))
        .agg(F.count("*").alias("_count"))
    )
    running = F.sum("_count").over(Window.partitionBy(key, "metric").orderBy(F.asc_nulls_first("value")))
    lower = F.floor((F.col("_n") + 1) / 2)
    upper = F.floor(F.col("_n") / 2) + 1
    # What lies below the bracket has a null value and comes first.
    missed = F.col("_a").isNull() | F.col("_b").isNull() | F.col("_early")
    middle = (F.col("_a") + F.col("_b")) / F.lit(2.0)
    outside = F.raise_error(F.lit("the median lies outside its bracket")).cast("double")
    return (
        counts.withColumn("_upto", running)
        .groupBy(key, "metric")
        .agg(
            F.min(F.when(F.col("_upto") >= lower, F.col("value"))).alias("_a"),
            F.min(F.when(F.col("_upto") >= upper, F.col("value"))).alias("_b"),
            F.bool_or(F.col("value").isNull() & (F.col("_upto") >= lower)).alias("_early"),
        )
        .select(key, "metric", F.when(missed, outside).otherwise(middle).alias("median"))
    )


def source_profile(stg: DataFrame) -> DataFrame:
    """Rows, median speed and median altitude per position source."""
    counts = stg.groupBy("position_source").agg(F.count("*").alias("rows"))
    medians = (
        exact_median(stg, "position_source", ["velocity", "baro_altitude"])
        .groupBy("position_source")
        .agg(
            F.max(F.when(F.col("metric") == "velocity", F.col("median"))).alias("median_velocity"),
            F.max(F.when(F.col("metric") == "baro_altitude", F.col("median"))).alias("median_altitude"),
        )
    )
    medians = medians.withColumnRenamed("position_source", "_source")
    same = F.col("position_source").eqNullSafe(F.col("_source"))
    return counts.join(medians, same, "left").drop("_source")


def source_first_seen(stg: DataFrame) -> DataFrame:
    """First and last day and number of days each source appears."""
    return stg.groupBy("position_source").agg(
        F.min(day_of(stg)).alias("first_day"),
        F.max(day_of(stg)).alias("last_day"),
        F.countDistinct(day_of(stg)).alias("days_seen"),
    )
