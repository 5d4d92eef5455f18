"""Raw snapshot files below ``<root>/region=<r>/dt=<yyyyMMdd>/``."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from overflight.functions.timeparts import compact_day, instant, utc_day
from overflight.schemas import RAW_SCHEMA


# Fixed value: the record separator ends each document of a packed file.
DOCUMENT_END = "\x1e"


def raw_path(region: str, epoch: int) -> str:
    """Path of one snapshot below the root; the same snapshot has the same path."""
    day = datetime.fromtimestamp(epoch, timezone.utc).strftime("%Y%m%d")
    return f"region={region}/dt={day}/states_{epoch}.json"


def _folders(root: str, regions: Sequence[str] | None, dts: Sequence[str] | None) -> str:
    """Glob over just the wanted partitions, so that a daily load lists one
    day of files and never the whole store."""
    region = "*" if regions is None else "{" + ",".join(regions) + "}"
    day = "*" if dts is None else "{" + ",".join(dts) + "}"
    return f"{root.rstrip('/')}/region={region}/dt={day}"


def read_raw(
    spark: SparkSession,
    root: str,
    dts: Sequence[str] | None = None,
    regions: Sequence[str] | None = None,
    *,
    pattern: str = "*.json",
    wholetext: bool = True,
) -> DataFrame:
    """``value, region, dt`` with one row per document.

    ``wholetext=False`` reads files with many documents, the packed layout
    ``land_raw`` writes. No matching file gives an empty frame.
    """
    reader = (
        spark.read.option("pathGlobFilter", pattern)
        .option("basePath", root)
        .schema(RAW_SCHEMA)
    )
    try:
        if not wholetext:
            reader = reader.option("lineSep", DOCUMENT_END)
        return reader.text(_folders(root, regions, dts), wholetext=wholetext)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], RAW_SCHEMA)
        raise


def latest_per_snapshot(raw: DataFrame) -> DataFrame:
    """Keep the last landed document per (region, snapshot time), or per piece
    of a snapshot that is cut into several documents.

    Stands in for "same snapshot, same path" where several documents share a
    file. ``raw`` must come straight from a file read. Each document is carried
    once, behind what orders it; the maximum combines on the map side, so many
    copies of one snapshot do not meet in one task.
    """
    head = F.from_json("value", "time BIGINT, piece BIGINT")
    stamped = raw.select(
        "region", "dt", head["time"].alias("_epoch"), head["piece"].alias("_piece"),
        F.struct("_metadata.file_modification_time", "_metadata.file_name", "value").alias("_landed"),
    )
    unread = stamped.where(F.col("_epoch").isNull())
    kept = (
        stamped.where(F.col("_epoch").isNotNull())
        .groupBy("region", "dt", "_epoch", "_piece")
        .agg(F.max("_landed").alias("_landed"))
    )
    return kept.unionByName(unread, allowMissingColumns=True).select("_landed.value", "region", "dt")


def land_raw(df: DataFrame, root: str) -> None:
    """Append documents ``(region, value)`` to the store, packed many to a file.

    Files are shared by the snapshots of a (region, day) rather than written
    one per snapshot, which keeps the store listable; read back with
    ``pattern='*.txt', wholetext=False`` and ``latest_per_snapshot``. Documents
    are kept as they are: a control character that JSON does not allow inside
    a document separates them, so line breaks may stay.
    """
    epoch = F.from_json("value", "time BIGINT", {"mode": "FAILFAST"})["time"]
    epoch = F.coalesce(epoch, F.raise_error(F.lit("document without time")).cast("bigint"))
    (
        df.select("value", "region", compact_day(epoch).alias("dt"))
        .hint("rebalance", "region", "dt")
        .write.mode("append")
        .option("lineSep", DOCUMENT_END)
        .partitionBy("region", "dt")
        .text(root)
    )


def stream_raw(spark: SparkSession, root: str, *, pattern: str = "*.json", wholetext: bool = True,
               max_files: int | None = None, stamped: bool = False) -> DataFrame:
    """Same rows as ``read_raw``, as new files arrive; ``stamped`` adds when
    and in which file a document landed (``landed_at, file``)."""
    reader = spark.readStream.option("pathGlobFilter", pattern).schema(RAW_SCHEMA)
    if not wholetext:
        reader = reader.option("lineSep", DOCUMENT_END)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.text(root, wholetext=wholetext)
    if not stamped:
        return stream
    return stream.select(
        "*", F.col("_metadata.file_modification_time").alias("landed_at"), F.col("_metadata.file_name").alias("file"))


def stream_listing(spark: SparkSession, root: str, *, pattern: str = "*.json") -> DataFrame:
    """``region, dt`` of new raw files as they arrive. The files are listed,
    not opened."""
    schema = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY, region STRING, dt STRING"
    files = spark.readStream.format("binaryFile").option("pathGlobFilter", pattern).schema(schema).load(root)
    return files.select("region", "dt")


def ingest_status(
    spark: SparkSession,
    root: str,
    as_of: datetime,
    *,
    regions: Sequence[str] | None = None,
    pattern: str = "*.json",
    max_lag_min: int = 20,
) -> DataFrame:
    """One row about the current day: files, newest file, lag, verdict.

    Lists files only; the binary source does not open a file whose content
    is not selected.
    """
    day = utc_day(as_of).strftime("%Y%m%d")
    try:
        files = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", pattern)
            .load(_folders(root, regions, [day]))
            .select("path", "modificationTime", "length")
        )
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "path STRING, modificationTime TIMESTAMP, length BIGINT")
    lag = F.floor(F.timestamp_diff("SECOND", F.col("newest"), instant(as_of)) / 60).cast("bigint")
    return (
        files.agg(
            F.count("*").alias("files"),
            F.sum("length").alias("bytes"),
            F.max("modificationTime").alias("newest"),
        )
        .withColumn("lag_minutes", lag)
        .withColumn(
            "status",
            F.when(F.col("files") == 0, "no files").when(F.col("lag_minutes") > max_lag_min, "late").otherwise("ok"),
        )
    )
