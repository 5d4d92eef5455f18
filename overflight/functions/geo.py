"""Box and grid expressions on lon/lat columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from overflight.config import BACKGROUND, REGIONS, Box

# Call cost by box area in square degrees (inclusive upper
# bounds); a larger box costs CREDIT_MAX.
CREDIT_STEPS = ((25.0, 1), (100.0, 2), (400.0, 3))
CREDIT_MAX = 4
DAILY_CREDITS = 4000


def in_box(lon: Column | str, lat: Column | str, box: Box) -> Column:
    """Inclusive test; NULL coordinates give NULL and so drop out of a filter."""
    lon = F.col(lon) if isinstance(lon, str) else lon
    lat = F.col(lat) if isinstance(lat, str) else lat
    return lon.between(float(box.lomin), float(box.lomax)) & lat.between(float(box.lamin), float(box.lamax))


def tag_region(
    lon: Column | str, lat: Column | str, boxes: Sequence[Box] = REGIONS, default: str = BACKGROUND
) -> Column:
    """Name of the first box, in the given order, that holds the point."""
    tag = F.lit(default)
    for box in reversed(boxes):
        tag = F.when(in_box(lon, lat, box), F.lit(box.region)).otherwise(tag)
    return tag


def snap_to_grid(col: Column | str, cell_deg: float) -> Column:
    """Lower edge of the grid cell; double arithmetic throughout."""
    col = F.col(col) if isinstance(col, str) else col
    cell = F.lit(float(cell_deg))
    return F.floor(col / cell).cast("double") * cell


def box_area(lomin: str = "lomin", lomax: str = "lomax", lamin: str = "lamin", lamax: str = "lamax") -> Column:
    return (F.col(lamax) - F.col(lamin)) * (F.col(lomax) - F.col(lomin))


def credit_cost(area: Column) -> Column:
    """Cost of one call for a box of this area."""
    cost = F.lit(CREDIT_MAX)
    for limit, credits in reversed(CREDIT_STEPS):
        cost = F.when(area <= F.lit(limit), F.lit(credits)).otherwise(cost)
    return cost
