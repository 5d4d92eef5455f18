"""Raw snapshot documents derived from a table of events.

Every event becomes one state vector, so the work grows with the table. Field
values are simple arithmetic on the event; ``oracles`` repeats it in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from overflight.functions.timeparts import time_bucket
from overflight.sources.bronze import to_bronze

# A document holds the events of one range of this many event ids, so it is
# bounded however many events share a snapshot time. The range's number is
# written into the document as ``piece``; the snapshot is the same for all.
PIECE_IDS = 65_536
REGION = "global"


# Schemas of the input tables; with them no file is opened to plan a query.
SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
}


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with ``ts`` as an instant."""
    return read_table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# The 17 elements of an event's state vector as JSON text; NULL becomes null.
_ELEMENTS = (
    "concat('\"', lower(hex(user_id)), '\"')",
    "concat('\"', if(event_id % 17 = 0, space(8), rpad(event_type, 8, ' ')), '\"')",
    "concat('\"Country ', user_id % 7, '\"')",
    "unix_seconds(ts)",
    "unix_seconds(ts) + 1",
    "-20D + (user_id * 7919 + event_id * 31) % 10000 / 100D",
    "10D + (user_id * 104729 + event_id * 17) % 5500 / 100D",
    "if(event_id % 13 = 0, NULL, value * 10D)",
    "event_type = 'error'",
    "value",
    "if(event_id % 20 = 0, 505.5D, event_id % 361)",
    "event_id % 41 - 20",
    "if(event_id % 11 = 0, format_string('[%d,7]', user_id), NULL)",
    "value * 10D + 5.5D",
    "if(event_id % 7 = 0, NULL, concat('\"', lpad(event_id % 7777, 4, '0'), '\"'))",
    "event_id % 50 = 0",
    "if(event_id % 20 = 0, 3, 0)",
)


def state_vector() -> Column:
    """JSON text of one event's 17-element state vector."""
    elements = ", ".join(f"coalesce(cast({element} AS STRING), 'null')" for element in _ELEMENTS)
    return F.expr(f"concat('[', concat_ws(',', {elements}), ']')")


def snapshot_epoch() -> Column:
    """Snapshots are due every ten minutes and come up to 40 seconds late, a
    lag that changes from one to the next."""
    due = F.unix_seconds(time_bucket("ts", 600))
    return due + F.pmod(F.floor(due / 600) * 7, F.lit(41))


def raw_documents(events: DataFrame, piece_ids: int = PIECE_IDS) -> DataFrame:
    """``value, region``: one document per snapshot and range of event ids."""
    vectors = events.select(
        snapshot_epoch().alias("epoch"),
        F.floor(F.col("event_id") / piece_ids).cast("bigint").alias("piece"),
        state_vector().alias("vector"),
    )
    states = F.array_join(F.collect_list("vector"), ",")
    document = F.format_string('{"time":%d,"piece":%d,"states":[%s]}', "epoch", "piece", states)
    return vectors.groupBy("epoch", "piece").agg(document.alias("value")).select("value", F.lit(REGION).alias("region"))


def bronze_from_events(spark: SparkSession, sf_dir: str, piece_ids: int = PIECE_IDS) -> DataFrame:
    """Bronze rows of all events, loaded at the midnight that closes their day."""
    bronze = to_bronze(raw_documents(read_events(spark, sf_dir), piece_ids))
    return bronze.withColumn("_loaded_at", F.date_add("dt", 1).cast("timestamp"))


def hourly_series(events: DataFrame) -> DataFrame:
    """Metric series ``ts, metric, label, value`` from the events of each hour.

    The mean is taken over whole hundredths, so that it does not depend on the
    order in which Spark adds.
    """
    hour = time_bucket("ts", 3600).alias("ts")
    hundredths = F.round(F.col("value") * 100).cast("bigint")
    by_type = (
        events.groupBy(hour, F.col("event_type").alias("label"))
        .agg((F.sum(hundredths) / (F.count("*") * 100)).alias("mean"))
        .selectExpr("ts", "label", "stack(2, 'coverage', mean / 100, 'density', mean) AS (metric, value)")
    )
    overall = (
        events.groupBy(hour)
        .agg(
            F.max("value").alias("top"),
            (F.count_if(F.col("event_type") == "error") > F.count_if(F.col("event_type") == "view")).alias("failed"),
            (F.count_distinct(time_bucket("ts", 600)) * 24).cast("double").alias("snapshots"),
        )
        .selectExpr(
            "ts", "'' AS label",
            "stack(3, 'freshness', top * 1000, 'query_success', if(failed, 0D, 1D), 'snapshot', snapshots) AS (metric, value)"
        )
    )
    return by_type.unionByName(overall).select("ts", "metric", "label", "value")
