"""Small reference tables: region boxes, areas, day spines."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from overflight.config import REGIONS, Box
from overflight.functions.geo import box_area
from overflight.functions.literals import sql_literal
from overflight.schemas import AREA_SCHEMA, BOX_SCHEMA


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A table written out in the plan. Unlike one made from a Python list,
    the optimizer knows how small it is and broadcasts it by itself."""
    fields = [field.split() for field in schema.split(", ")]
    values = ", ".join(
        "(" + ", ".join(f"CAST({sql_literal(v)} AS {dtype})" for v, (_, dtype) in zip(row, fields, strict=True)) + ")"
        for row in rows
    )
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(name for name, _ in fields)})")


def box_table(spark: SparkSession, boxes: Sequence[Box] = REGIONS) -> DataFrame:
    rows = [
        (b.region, n, float(b.lomin), float(b.lomax), float(b.lamin), float(b.lamax)) for n, b in enumerate(boxes, 1)
    ]
    return literal_table(spark, rows, BOX_SCHEMA)


def region_area(spark: SparkSession, boxes: Sequence[Box] = REGIONS) -> DataFrame:
    """``region, area_sqdeg`` derived from the boxes."""
    return box_table(spark, boxes).select("region", box_area().alias("area_sqdeg"))


def read_region_area(spark: SparkSession, path: str) -> DataFrame:
    """The same table from a CSV file with a header."""
    return spark.read.option("header", True).option("enforceSchema", False).schema(AREA_SCHEMA).csv(path)


def day_spine(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day of the closed range."""
    days = F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))
    return spark.range(1).select(F.explode(days).alias("dt"))
