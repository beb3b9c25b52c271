"""Bounding-box expressions. A box is a struct of four doubles; a row without a shape has null fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SIDES = ("xmin", "ymin", "xmax", "ymax")
BOX_TYPE = "struct<xmin: double, ymin: double, xmax: double, ymax: double>"


def box(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    return F.struct(xmin.alias("xmin"), ymin.alias("ymin"), xmax.alias("xmax"), ymax.alias("ymax"))


def side(bbox: str, name: str) -> Column:
    return F.col(f"{bbox}.{name}")


def larger_side(bbox: str = "bbox") -> Column:
    return F.greatest(side(bbox, "xmax") - side(bbox, "xmin"), side(bbox, "ymax") - side(bbox, "ymin"))


def box_area(bbox: str = "bbox") -> Column:
    return (side(bbox, "xmax") - side(bbox, "xmin")) * (side(bbox, "ymax") - side(bbox, "ymin"))


def centre_x(bbox: str = "bbox") -> Column:
    return (side(bbox, "xmin") + side(bbox, "xmax")) / F.lit(2.0)


def centre_y(bbox: str = "bbox") -> Column:
    return (side(bbox, "ymin") + side(bbox, "ymax")) / F.lit(2.0)


def intersects(area: tuple[float, float, float, float], bbox: str = "bbox") -> Column:
    """Closed test against (west, south, east, north): touching counts. Four plain comparisons, so
    Parquet row-group statistics can answer them."""
    west, south, east, north = (float(v) for v in area)
    return (
        (side(bbox, "xmax") >= west)
        & (side(bbox, "xmin") <= east)
        & (side(bbox, "ymax") >= south)
        & (side(bbox, "ymin") <= north)
    )


def overlaps(area: tuple[float, float, float, float], bbox: str = "bbox") -> Column:
    """Open test: boxes that only touch do not count."""
    west, south, east, north = (float(v) for v in area)
    return (
        (side(bbox, "xmax") > west)
        & (side(bbox, "xmin") < east)
        & (side(bbox, "ymax") > south)
        & (side(bbox, "ymin") < north)
    )


def above_size(tolerance: float | Column, bbox: str = "bbox") -> Column:
    return larger_side(bbox) > tolerance


def clamp_wgs84(bbox: str = "bbox") -> Column:
    """The box cut to the valid longitude and latitude range; null fields stay null."""

    def at_least(low: float, name: str) -> Column:
        return F.when(side(bbox, name).isNotNull(), F.greatest(F.lit(low), side(bbox, name)))

    def at_most(high: float, name: str) -> Column:
        return F.when(side(bbox, name).isNotNull(), F.least(F.lit(high), side(bbox, name)))

    return box(at_least(-180.0, "xmin"), at_least(-90.0, "ymin"), at_most(180.0, "xmax"), at_most(90.0, "ymax"))


def ring(bbox: str = "bbox") -> Column:
    """The box as a closed ring of five points, counter-clockwise from the south-west corner."""
    w, s, e, n = (side(bbox, name) for name in SIDES)
    return F.array(*(F.array(x, y) for x, y in ((w, s), (e, s), (e, n), (w, n), (w, s))))


def as_list(bbox: str = "bbox") -> Column:
    return F.array(*(side(bbox, name) for name in SIDES))


def union_aggregates(bbox: str = "bbox") -> list[Column]:
    """Aggregates for the box around a group of boxes; rows without a box are ignored."""
    return [
        F.min(side(bbox, "xmin")).alias("xmin"),
        F.min(side(bbox, "ymin")).alias("ymin"),
        F.max(side(bbox, "xmax")).alias("xmax"),
        F.max(side(bbox, "ymax")).alias("ymax"),
    ]


def mercator_y(latitude: Column) -> Column:
    """Web Mercator ordinate of a latitude, which is first held to +-85 degrees."""
    held = F.greatest(F.lit(-85.0), F.least(F.lit(85.0), latitude))
    return F.log(F.tan(F.lit(0.7853981633974483) + F.radians(held) / F.lit(2.0)))
