"""Raw files and bronze rows as streams; late data reloads whole days."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from overflight.config import Config
from overflight.plans.pipeline import Layout, rebuild_changed
from overflight.schemas import BRONZE_SCHEMA
from overflight.sources import ledger
from overflight.sources.bronze import load_days, snapshot_epoch
from overflight.sources.raw import stream_listing, stream_raw
from overflight.sources.reference import literal_table
from overflight.sources.storage import exists, read_table
from overflight.streaming.runs import batch_path, run_id


def run_available(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process what has arrived and stop."""
    query: StreamingQuery = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def stream_bronze(spark: SparkSession, path: str) -> DataFrame:
    """New files of a bronze table as a stream."""
    return spark.readStream.schema(BRONZE_SCHEMA).parquet(path)


def note_arrivals(spark: SparkSession, root: str, checkpoint: str, *, pattern: str = "*.json") -> DataFrame:
    """Record which day folders got new files; returns ``dt, batch_id`` of all
    records. A replayed batch rewrites its own record."""
    path = f"{checkpoint}-arrived"

    def note(batch: DataFrame, batch_id: int) -> None:
        batch.select("dt").distinct().coalesce(1).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    arrivals = stream_listing(spark, root, pattern=pattern)
    run_available(arrivals.writeStream.foreachBatch(note), checkpoint)
    return read_table(spark, path, "dt STRING, batch_id BIGINT")


def _due_days(arrived: DataFrame, done: DataFrame, before: date | None) -> list[str]:
    """Closed days with arrivals that were not loaded since; a few per run."""
    due = arrived.join(done, ["dt", "batch_id"], "left_anti")
    if before is not None:
        due = due.where(F.col("dt") < before.strftime("%Y%m%d"))
    return sorted(row.dt for row in due.select("dt").distinct().collect())


def ingest(
    spark: SparkSession, root: str, bronze_path: str, checkpoint: str, *, pattern: str = "*.json", packed: bool = False,
    regions: Sequence[str] | None = None, max_files: int = 1000,
) -> None:
    """Bring a bronze table that is kept by piece up to date with all files that arrived, open days included.

    A batch costs its new files and the (region, six hours) pieces they belong to,
    whatever the day already holds. See ``merge_pieces``.
    """
    stream = stream_raw(spark, root, pattern=pattern, wholetext=not packed, max_files=max_files, stamped=True)
    if regions is not None:
        stream = stream.where(F.col("region").isin(list(regions)))
    run_available(stream.writeStream.foreachBatch(merge_pieces(bronze_path)), checkpoint)


def merge_pieces(bronze_path: str) -> Callable[[DataFrame, int], None]:
    """Sink for stamped raw documents: last copy wins, per piece of the table.

    Documents that cannot be read, or lie in the folder of another day, go to
    ``<path>-quarantine``. The others are merged with the stored rows of the
    pieces they touch: of the copies of a (region, snapshot time, piece number)
    the last landed one stays. The merged pieces, and the ledger rows of their
    days, are complete in a folder of their own before they replace the stored
    ones, so a batch that is repeated after a crash half-way takes them from
    there and loses nothing. Two such folders take turns.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark, mark = batch.sparkSession, f"{run_id(batch)}-{batch_id}"
        ready = f"{bronze_path}-merging/slot={batch_id % 2}"
        if not _is_ready(spark, f"{ready}/ledger", mark):
            documents = _documents(batch)
            good = F.col("dt") == F.to_date("folder", "yyyyMMdd")
            aside = documents.where(~F.coalesce(good, F.lit(False))).select(F.col("raw").alias("value"), "region", "folder", "file")
            aside.write.mode("overwrite").parquet(batch_path(f"{bronze_path}-quarantine", batch, batch_id))
            new = documents.where(good).drop("folder")
            touched = [tuple(row) for row in new.select(*ledger.PIECE).distinct().collect()]
            merged = _last_landed(_pieces(read_table(spark, bronze_path, PIECES_SCHEMA), touched).unionByName(new))
            merged.write.mode("overwrite").parquet(f"{ready}/rows")
            entries = ledger.entries(spark.read.schema(PIECES_SCHEMA).parquet(f"{ready}/rows"))
            others = _pieces(ledger.read_ledger(spark, bronze_path), touched, "left_anti")
            both = entries.unionByName(others).withColumn("_mark", F.lit(mark))
            both.coalesce(1).write.mode("overwrite").parquet(f"{ready}/ledger")
        (
            spark.read.schema(PIECES_SCHEMA).parquet(f"{ready}/rows").hint("rebalance", *ledger.PIECE)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*ledger.PIECE).parquet(bronze_path)
        )
        ledger.record(spark.read.schema(ledger.LEDGER_SCHEMA).parquet(f"{ready}/ledger"), bronze_path)

    return merge


PIECES_SCHEMA = (
    "snapshot_time TIMESTAMP, raw STRING, _loaded_at TIMESTAMP, piece BIGINT, landed_at TIMESTAMP, file STRING, "
    "dt DATE, region STRING, hour INT"
)


def _is_ready(spark: SparkSession, path: str, mark: str) -> bool:
    """Whether this batch was merged before and did not get to its end. The folder is written last."""
    return exists(spark, f"{path}/_SUCCESS") and not read_table(spark, path, "_mark STRING").where(F.col("_mark") == mark).isEmpty()


def _documents(batch: DataFrame) -> DataFrame:
    """Stamped raw documents as rows of bronze; what cannot be read has no day."""
    head = F.from_json("value", "piece BIGINT")
    time = snapshot_epoch("PERMISSIVE")
    rows = batch.select(
        F.timestamp_seconds(time).alias("snapshot_time"), F.col("value").alias("raw"), F.current_timestamp().alias("_loaded_at"),
        head["piece"].alias("piece"), "landed_at", "file", "region", F.col("dt").alias("folder"),
    )
    return rows.withColumn("dt", F.to_date("snapshot_time")).withColumn("hour", ledger.piece_hour())


def _pieces(stored: DataFrame, touched: Sequence[tuple], how: str = "left_semi") -> DataFrame:
    """Stored rows of the pieces that new documents belong to, or (anti) the other rows of their days. A batch
    touches at most four pieces a file; files of other pieces, or days, are not opened."""
    if not touched:
        return stored.limit(0)
    for name, values in zip(ledger.PIECE if how == "left_semi" else ["dt"], zip(*touched)):
        stored = stored.where(F.col(name).isin(sorted(set(values))))
    pieces = literal_table(stored.sparkSession, touched, "dt DATE, region STRING, hour INT")
    return stored.join(pieces, list(ledger.PIECE), how)


def _last_landed(rows: DataFrame) -> DataFrame:
    """One row per (region, snapshot time, piece number). Each document is carried once, behind what orders
    it; the maximum combines on the map side, so many copies do not meet in one task."""
    keys = ["dt", "region", "hour", "snapshot_time", "piece"]
    landed = F.struct("landed_at", "file", "raw", "_loaded_at")
    return rows.groupBy(*keys).agg(F.max(landed).alias("_landed")).select(*keys, "_landed.*")


def close_days(
    spark: SparkSession, root: str, bronze_path: str, checkpoint: str, *, pattern: str = "*.json", packed: bool = False,
    before: date | None = None, regions: Sequence[str] | None = None,
    after_load: Callable[[Sequence[date]], None] | None = None,
) -> None:
    """Load every closed day that new or late files belong to, as a whole.

    The stream only says which days changed; these are read again in full and
    replaced, so a replayed batch, a repeated or a late file never counts
    twice. Days from ``before`` on are still open: they stay on record and are
    loaded by the first run after they closed, new files or not. A run that
    dies before its record is written loads the same days again.
    """
    arrived = note_arrivals(spark, root, checkpoint, pattern=pattern)
    path = f"{checkpoint}-loaded"
    days = _due_days(arrived, read_table(spark, path, "dt STRING, batch_id BIGINT"), before)
    if days:
        load_days(spark, root, bronze_path, days, regions=regions, pattern=pattern, packed=packed)
        if after_load is not None:
            after_load([date(int(d[:4]), int(d[4:6]), int(d[6:])) for d in days])
        arrived.where(F.col("dt").isin(days)).coalesce(1).write.mode("append").parquet(path)


def apply_late(
    spark: SparkSession, root: str, layout: Layout, checkpoint: str, cfg: Config = Config(), *, pattern: str = "*.json",
    packed: bool = False, before: date | None = None, areas: DataFrame | None = None,
) -> list[date]:
    """``close_days`` plus staging, marts and all their checks for exactly the
    reloaded days that hold something else than what their layers were built
    from. ``areas`` are those of the build. A failing check leaves the days on
    record, so that the next run takes them up again. Returns the rebuilt days."""
    rebuilt: list[date] = []

    def rebuild(days: Sequence[date]) -> None:
        rebuilt.extend(rebuild_changed(spark, layout, cfg, days, areas))

    close_days(spark, root, layout.bronze, checkpoint, pattern=pattern, packed=packed, before=before, after_load=rebuild)
    return rebuilt
