"""Cell ids ``CRS<epsg>RES<r>mN<y>E<x>`` and cell arithmetic; (x, y) is a cell's lower-left corner in metres."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ID = r"^CRS(\d+)RES(\d+)mN(-?\d+)E(-?\d+)$"
_PART = {"crs": 1, "res": 2, "y": 3, "x": 4}


def cell_id(x, y, res, crs=3035) -> Column:
    """Id of a cell; coordinates are cut to whole metres towards zero. Null coordinates give a null id."""
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.concat(F.lit("CRS"), as_col(crs).cast("string"), F.lit("RES"), as_col(res).cast("string"), F.lit("mN"), as_col(y).cast("long").cast("string"), F.lit("E"), as_col(x).cast("long").cast("string"))


def cell_part(grd_id: Column, part: str) -> Column:
    """``crs``, ``res``, ``x`` or ``y`` of an id as long; null where the id is malformed."""
    return F.regexp_extract(grd_id, _ID, _PART[part]).try_cast("long")


def snap(v: Column, step) -> Column:
    """The multiple of step at or below v."""
    return (F.floor(v / F.lit(step)) * F.lit(step)).cast("long")


def snap_up(v: Column, step) -> Column:
    """The multiple of step at or above v."""
    return (F.ceil(v / F.lit(step)) * F.lit(step)).cast("long")


def half_even(v: Column, digits: int = 0) -> Column:
    """Rounding with halves to the even neighbour; digits may be negative."""
    return F.bround(v, digits)


def saturate_short(v: Column) -> Column:
    """At most the largest 16-bit whole number."""
    return F.least(v, F.lit(32767))


def iceland_cell_id(local_id: Column) -> Column:
    """``1kmN500E600`` to ``CRS9947RES1000mN500000E600000``."""
    plain = F.replace(F.replace(local_id, F.lit("1km"), F.lit("")), F.lit("E"), F.lit("000E"))
    return F.concat(F.lit("CRS9947RES1000m"), plain, F.lit("000"))


def without_country(cell: Column) -> Column:
    """A cell id without its three-character country prefix."""
    return F.substring(cell, 4, 1 << 30)


def country_of_file(path: Column) -> Column:
    """Characters 15 and 16 of a file's name."""
    return F.substring(F.element_at(F.split(path, "/"), -1), 15, 2)


def survey_point_xy(point_id: Column) -> tuple[Column, Column]:
    """(x, y) of an eight-digit point id: four digits of kilometres each."""
    return F.substring(point_id, 1, 4).cast("long") * 1000, F.substring(point_id, -4, 4).cast("long") * 1000


def pixel_index(x: Column, y: Column, minx, maxy, res) -> tuple[Column, Column]:
    """(row, column) of a cell's lower-left corner in a raster whose upper-left corner is (minx, maxy)."""
    col = ((x - F.lit(minx)) / F.lit(res)).cast("long")
    return ((F.lit(maxy) - y) / F.lit(res)).cast("long") - 1, col


def pixel_corner(row: Column, col: Column, minx, maxy, res) -> tuple[Column, Column]:
    """Lower-left corner (x, y) of a pixel."""
    return F.lit(minx) + col * F.lit(res), F.lit(maxy) - (row + 1) * F.lit(res)


def cell_centre(x: Column, y: Column, res) -> tuple[Column, Column]:
    return x + F.lit(res) / 2, y + F.lit(res) / 2


def cell_ring(x: Column, y: Column, res) -> Column:
    """Closed ring of a cell's corners, from the lower left counter-clockwise."""
    far = lambda v: v + F.lit(res)
    corners = [(x, y), (far(x), y), (far(x), far(y)), (x, far(y)), (x, y)]
    return F.array(*[F.array(a.cast("double"), b.cast("double")) for a, b in corners])
