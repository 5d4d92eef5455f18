"""Output of streams by run. A run is a checkpoint: it goes on after a
restart, and a new checkpoint starts another one, with batch numbers of its
own. Batches of different runs never mix, and readers see the newest run."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from overflight.sources.storage import read_table

RUN_SCHEMA = "started_at TIMESTAMP, run STRING"


def run_id(batch: DataFrame) -> str:
    """Of the stream a micro-batch belongs to; kept in its checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def batch_path(path: str, batch: DataFrame, batch_id: int) -> str:
    return f"{path}/run={run_id(batch)}/batch_id={batch_id}"


def note_run(path: str, batch: DataFrame) -> None:
    """Record the start of a run, with its first batch."""
    started = batch.sparkSession.range(1).select(F.current_timestamp().alias("started_at"))
    started.coalesce(1).write.mode("overwrite").parquet(f"{path}/runs/run={run_id(batch)}")


def write_batch(path: str) -> Callable[[DataFrame, int], None]:
    """Sink: each batch in a folder of its run, which a replay of the batch overwrites."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id == 0:
            note_run(path, batch)
        batch.write.mode("overwrite").parquet(batch_path(f"{path}/rows", batch, batch_id))

    return write


def newest_run(spark: SparkSession, path: str) -> str | None:
    """The run that started last; one small row per run tells which."""
    return read_table(spark, f"{path}/runs", RUN_SCHEMA).agg(F.max_by("run", "started_at")).first()[0]


def latest_run(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of the run that started last."""
    return _batches(spark, path, schema).drop("run", "batch_id")


def _batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    rows = read_table(spark, f"{path}/rows", f"{schema}, run STRING, batch_id BIGINT")
    return rows.where(F.col("run") == F.lit(newest_run(spark, path)))


def read_latest(spark: SparkSession, path: str, keys: Sequence[str], schema: str) -> DataFrame:
    """The last update of every key of an update stream: the folded updates and those after them."""
    upto, folded = _folded(spark, path, schema)
    return _last(folded.unionByName(_batches(spark, path, schema).drop("run").where(F.col("batch_id") > upto)), keys)


def fold(spark: SparkSession, path: str, keys: Sequence[str], schema: str) -> None:
    """Fold all updates so far into one row per key, which readers start from.

    Run it now and then, such as once a day has closed: reading then costs the
    keys and the updates since, not every update there ever was. A fold that is
    repeated, or dies, leaves the one before in force.
    """
    upto, folded = _folded(spark, path, schema)
    updates = _batches(spark, path, schema).drop("run").where(F.col("batch_id") > upto)
    run, last = newest_run(spark, path), updates.agg(F.max("batch_id")).first()[0]
    if last is None:
        return
    rows = folded.unionByName(updates.where(F.col("batch_id") <= last))
    target = f"{path}/folded/run={run}/upto={last}"
    _last(rows, keys).write.mode("overwrite").parquet(target)
    done = spark.range(1).select(F.lit(last).cast("bigint").alias("upto"))
    done.coalesce(1).write.mode("overwrite").parquet(f"{path}/folds/run={run}")


def _folded(spark: SparkSession, path: str, schema: str) -> tuple[int, DataFrame]:
    """The last batch that is folded, and the rows as of then."""
    run = newest_run(spark, path)
    row = read_table(spark, f"{path}/folds", "upto BIGINT, run STRING").where(F.col("run") == F.lit(run)).first()
    upto = -1 if row is None else row["upto"]
    rows = read_table(spark, f"{path}/folded/run={run}/upto={upto}", schema)
    return upto, rows.withColumn("batch_id", F.lit(upto).cast("bigint"))


def _last(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    values = [c for c in rows.columns if c not in (*keys, "batch_id")]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("v"))
    return latest.select(*keys, "v.*")
