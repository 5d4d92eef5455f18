"""Day-partitioned Parquet storage: replace whole days, keep all others."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F


def guard_day(df: DataFrame, expected: date | Column, day: str = "dt") -> DataFrame:
    """Fail the job when a row belongs to another day than the one being
    loaded; such a row would otherwise wipe that other day."""
    expected = expected if isinstance(expected, Column) else F.lit(expected)
    stray = F.raise_error(
        F.format_string("row of day %s in a load of day %s", F.col(day).cast("string"), expected.cast("string"))
    ).cast("date")
    return df.withColumn(day, F.when(F.col(day) == expected, F.col(day)).otherwise(stray))


def _packed(df: DataFrame, day: str, clustered: bool, order: Sequence[Column] = ()) -> DataFrame:
    """Rows arranged for a write by day, within a file in ``order``.

    The rebalance hint packs a day into files of the advisory size and lets
    AQE split a day that is far larger than the others over several tasks.
    ``clustered`` rows, a narrow transformation of a table stored by day, lie
    together already and are written as they come, without a shuffle.
    """
    packed = df if clustered else df.hint("rebalance", day)
    return packed.sortWithinPartitions(day, *order) if order else packed


def write_days(df: DataFrame, path: str, day: str = "dt", clustered: bool = False, order: Sequence[Column] = ()) -> None:
    """Replace the days present in ``df``; an empty frame changes nothing."""
    (
        _packed(df, day, clustered, order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def replace_days(
    df: DataFrame, path: str, days: Iterable[date], day: str = "dt", clustered: bool = False, order: Sequence[Column] = ()
) -> None:
    """Make ``path`` hold exactly the rows of ``df`` for ``days``.

    Unlike ``write_days``, a listed day without rows ends up empty, so a
    derived table rebuilt by day equals one rebuilt in full.
    """
    days, written = set(days), Observation()
    observed = df.where(F.col(day).isin(list(days))).observe(written, F.collect_set(day).alias("days"))
    write_days(observed, path, day, clustered, order)
    for empty in sorted(days - set(written.get["days"])):
        target = f"{path.rstrip('/')}/{day}={empty.isoformat()}"
        if exists(df.sparkSession, target):
            df.drop(day).limit(0).write.mode("overwrite").parquet(target)


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parquet with a given schema; an absent table reads as empty."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def layer_name(env: str, layer: str | None, default: str = "default") -> str:
    """Database of a layer: production uses the plain name, any other
    environment a prefixed one, so that a trial run cannot touch production."""
    if layer is None:
        return default
    layer = layer.strip()
    return layer if env == "prod" else f"{env}_{layer}"


def materialize(
    df: DataFrame,
    name: str,
    mode: str = "view",
    *,
    path: str | None = None,
    days: Iterable[date] | None = None,
    clustered: bool = False,
    order: Sequence[Column] = (),
) -> DataFrame:
    """Publish a layer as a ``view``, a fully refreshed ``table``, or replaced ``days``.

    ``table`` goes to ``path`` if one is given, else to the catalog.
    """
    spark = df.sparkSession
    if mode == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if mode == "table":
        by_day = "dt" in df.columns
        packed = _packed(df, "dt", clustered, order) if by_day else df.hint("rebalance")
        writer = packed.write.mode("overwrite").format("parquet")
        if by_day:
            writer = writer.partitionBy("dt")
        if path is None:
            writer.saveAsTable(name)
            return spark.table(name)
        writer.save(path)
        return spark.read.schema(df.schema).parquet(path)
    if mode == "days":
        if path is None or days is None:
            raise ValueError("mode 'days' needs a path and the days to replace")
        replace_days(df, path, days, clustered=clustered, order=order)
        return spark.read.schema(df.schema).parquet(path)
    raise ValueError(f"unknown mode {mode!r}")
