"""Operators on tables of boxes ``region, priority, lomin, lomax, lamin, lamax``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from overflight.config import BACKGROUND
from overflight.functions.geo import DAILY_CREDITS, box_area, credit_cost


LEVELS = 8
STEP = 4.0  # sides of the cells of one level, of those of the level below; a power of two, so that cells nest exactly
MOST = 16  # boxes a cell lists before it hands them to the cells below it
EDGES = ("lomin", "lomax", "lamin", "lamax")
CANDIDATE = ("priority", "region", *EDGES)


def _ends(low: str, high: str, cell: Column) -> tuple[Column, Column]:
    """Numbers of the first and the last cell that the box touches."""
    return F.floor(F.col(low) / cell).cast("bigint"), F.floor(F.col(high) / cell).cast("bigint")


def _cells(low: str, high: str, cell: Column) -> Column:
    return F.explode(F.sequence(*_ends(low, high, cell)))


def box_level(cell: tuple[float, float], levels: int = LEVELS) -> Column:
    """The lowest level whose cells are no smaller than the box."""
    larger = F.greatest((F.col("lomax") - F.col("lomin")) / F.lit(float(cell[0])), (F.col("lamax") - F.col("lamin")) / F.lit(float(cell[1])))
    steps = [F.when(larger > F.lit(STEP**n), 1).otherwise(0) for n in range(levels - 1)]
    return sum(steps, F.lit(0))


def box_index(boxes: DataFrame, cell: tuple[float, float], levels: int = LEVELS) -> DataFrame:
    """``level, cx, cy`` and the box: on the level of its own size a box touches at most four cells, however large it is."""
    leveled = boxes.withColumn("level", box_level(cell, levels))
    side = F.pow(F.lit(STEP), F.col("level"))
    return leveled.withColumn("cx", _cells("lomin", "lomax", side * F.lit(float(cell[0])))).withColumn(
        "cy", _cells("lamin", "lamax", side * F.lit(float(cell[1]))))


def _listed(rows: DataFrame) -> DataFrame:
    """``level, cx, cy, boxes``: each cell's boxes in priority order."""
    return rows.groupBy("level", "cx", "cy").agg(F.sort_array(F.collect_list(F.struct(*CANDIDATE))).alias("boxes"))


def box_lists(boxes: DataFrame, cell: tuple[float, float], levels: int = LEVELS, most: int = MOST) -> DataFrame:
    """``level, cx, cy, boxes``: an index for many boxes that lie over each other, to be stored and given to ``assign_box``.

    A box starts in its cells of ``box_index``. Behind a box that covers a cell
    no other counts there, and of equal boxes only the first does. A cell left
    with more than ``most`` boxes keeps the one that covers it and hands the
    others to those of its cells on the level below that they touch; there more
    are covered. Only what still crosses a cell of the lowest level is listed
    without a bound.
    """
    first = F.min(F.struct("priority", "region")).alias("first")
    rows = box_index(boxes.groupBy(*EDGES).agg(first).select("first.*", *EDGES), cell, levels)
    at = Window.partitionBy("level", "cx", "cy")
    before = at.orderBy(*CANDIDATE).rowsBetween(Window.unboundedPreceding, -1)
    for level in reversed(range(levels)):
        side = F.pow(F.lit(STEP), F.col("level"))
        (x0, x1), (y0, y1) = (_ends(*EDGES[n:n + 2], side * F.lit(float(cell[n // 2]))) for n in (0, 2))
        covers = (x0 < F.col("cx")) & (F.col("cx") < x1) & (y0 < F.col("cy")) & (F.col("cy") < y1)
        rows = rows.withColumn("covers", covers).withColumn("hidden", F.bool_or("covers").over(before))
        rows = rows.where(~F.coalesce("hidden", F.lit(False)))
        if level:
            down = (F.col("level") == level) & ~F.col("covers") & (F.count("*").over(at) > most)
            rows = rows.withColumn("down", down)
            for n, name in ((0, "cx"), (2, "cy")):
                begin, end = _ends(*EDGES[n:n + 2], F.lit(float(cell[n // 2]) * STEP ** (level - 1)))
                inner = F.col(name) * int(STEP)
                below = F.sequence(F.greatest(inner, begin), F.least(inner + int(STEP) - 1, end))
                rows = rows.withColumn(name, F.explode(F.when(F.col("down"), below).otherwise(F.array(name))))
            rows = rows.withColumn("level", F.col("level") - F.col("down").cast("int"))
    return _listed(rows)


def assign_box(
    points: DataFrame,
    boxes: DataFrame,
    lon: str = "longitude",
    lat: str = "latitude",
    cell: tuple[float, float] = (5.0, 5.0),
    default: str = BACKGROUND,
    levels: int = LEVELS,
    lists: DataFrame | None = None,
) -> DataFrame:
    """Add ``region``: the box of lowest priority number that holds the point.

    Boxes are indexed by the grid cells they touch, which turns the range join
    into an equality join on the cell; points are never paired with all boxes.
    There are ``levels`` grids, ``cell`` being the cells of the finest one, and
    a box lies on the one that fits its size, so that it has at most four
    rows. A point looks up its cell on each level; levels without boxes drop
    out when the query runs. Each cell carries its candidates in priority
    order, so a point meets at most one row a level and needs no later
    grouping. Spark broadcasts an index or joins by shuffle, with AQE splitting
    hot cells, by its actual size.

    Where thousands of boxes lie over each other, give their stored
    ``box_lists`` of the same cells and levels as ``lists``: the same result,
    with a few boxes to look through on each level.
    """
    x, y = F.col(lon), F.col(lat)
    index = _listed(box_index(boxes, cell, levels)) if lists is None else lists
    found = points.withColumn("_best", F.lit(None).cast(index.schema["boxes"].dataType.elementType))
    for level in range(levels):
        cx, cy = (F.lit(float(side) * STEP**level) for side in cell)
        here = index.where(F.col("level") == level).select(
            F.col("cx").alias("_cx"), F.col("cy").alias("_cy"), F.col("boxes").alias("_boxes"))
        at = [F.col("_cx") == F.floor(x / cx).cast("bigint"), F.col("_cy") == F.floor(y / cy).cast("bigint")]
        inside = F.filter("_boxes", lambda b: x.between(b["lomin"], b["lomax"]) & y.between(b["lamin"], b["lamax"]))
        found = found.join(here, at, "left").withColumn("_best", F.least("_best", F.get(inside, F.lit(0))))
        found = found.drop("_cx", "_cy", "_boxes")
    return found.withColumn("region", F.coalesce(F.col("_best")["region"], F.lit(default))).drop("_best")


def observed_extents(stg: DataFrame, key: str = "region") -> DataFrame:
    """Box table of the positions seen per ``key``."""
    return stg.groupBy(F.col(key).alias("region")).agg(
        F.min("longitude").alias("lomin"),
        F.max("longitude").alias("lomax"),
        F.min("latitude").alias("lamin"),
        F.max("latitude").alias("lamax"),
    )


def with_area(boxes: DataFrame) -> DataFrame:
    return boxes.withColumn("area_sqdeg", box_area())


def credit_budget(boxes: DataFrame, interval_minutes: int = 10, budget: int = DAILY_CREDITS) -> DataFrame:
    """Cost per call, calls and credits per day and the share of the budget."""
    calls = F.lit(24 * 60 // interval_minutes)
    return (
        with_area(boxes)
        .withColumn("credits_per_call", credit_cost(F.col("area_sqdeg")).cast("bigint"))
        .withColumn("calls_per_day", calls.cast("bigint"))
        .withColumn("credits_per_day", F.col("credits_per_call") * F.col("calls_per_day"))
        .withColumn("budget_pct", F.round(F.col("credits_per_day") * F.lit(100.0) / F.lit(float(budget)), 1))
    )


def geojson_features(boxes: DataFrame) -> DataFrame:
    """``region, feature``: a GeoJSON Feature with a closed five-point ring per box."""
    corner = lambda lon, lat: F.array(F.col(lon), F.col(lat))
    ring = F.array(
        corner("lomin", "lamin"),
        corner("lomax", "lamin"),
        corner("lomax", "lamax"),
        corner("lomin", "lamax"),
        corner("lomin", "lamin"),
    )
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct("region").alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"),
    )
    return boxes.select("region", F.to_json(feature).alias("feature"))


def region_geojson(boxes: DataFrame) -> DataFrame:
    """One row, one column ``geojson``: the FeatureCollection of a few boxes,
    for a map that wants one document. Any number of boxes is written as one
    feature per row by ``geojson_features``."""
    ordered = F.sort_array(F.collect_list(F.struct("region", "feature")))
    features = F.array_join(F.transform(ordered, lambda row: row["feature"]), ",")
    return geojson_features(boxes).agg(
        F.concat(F.lit('{"type":"FeatureCollection","features":['), features, F.lit("]}")).alias("geojson")
    )
