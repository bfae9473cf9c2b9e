"""Geometry as arrays: a point is [x, y] or [x, y, z], a line an array of points, a polygon an array of closed rings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, then) -> Column:
    """then(value) with the value worked out once, however often ``then`` uses it."""
    return F.transform(F.array(value), then)[0]


def segments(line: Column) -> Column:
    """The line's segments, each an array of two points; [] for fewer than two points."""
    return F.when(F.size(line) >= 2, F.transform(F.sequence(F.lit(1), F.size(line) - 1), lambda i: F.slice(line, i, 2))).otherwise(F.slice(F.array(line), 2, 1))


def chunks(line: Column, n: int) -> Column:
    """Runs of n points that share none; a last run of one point is dropped."""
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(line), F.lit(1)), F.lit(n)), lambda i: F.slice(line, i, n))
    return F.filter(runs, lambda r: F.size(r) >= 2)


def point_distance(a: Column, b: Column) -> Column:
    return F.hypot(a[0] - b[0], a[1] - b[1])


def line_length(line: Column) -> Column:
    return F.aggregate(segments(line), F.lit(0.0), lambda t, s: t + point_distance(s[0], s[1]))


def densify(line: Column, step: float) -> Column:
    """The line with points added so that no segment is longer than step; its own points stay."""

    def cut(s: Column) -> Column:
        n = F.greatest(F.ceil(point_distance(s[0], s[1]) / step).cast("int"), F.lit(1))
        inner = F.filter(F.sequence(F.lit(1), n), lambda i: i < n)
        return F.concat(F.array(s[0]), F.transform(inner, lambda i: F.array(s[0][0] + (s[1][0] - s[0][0]) * i / n, s[0][1] + (s[1][1] - s[0][1]) * i / n)))

    return F.when(F.size(line) < 2, line).otherwise(F.concat(F.flatten(F.transform(segments(line), cut)), F.slice(line, -1, 1)))


def ends(line: Column) -> Column:
    """The segment from the first point to the last."""
    return F.array(F.element_at(line, 1), F.element_at(line, -1))


def ring_area(ring: Column) -> Column:
    """Signed area; positive counter-clockwise."""
    return F.aggregate(segments(ring), F.lit(0.0), lambda t, s: t + (s[0][0] * s[1][1] - s[1][0] * s[0][1])) / 2


def polygon_area(rings: Column) -> Column:
    """Area of the first ring without the others (holes)."""
    areas = F.transform(rings, lambda r: F.abs(ring_area(r)))
    return F.aggregate(areas, F.lit(0.0), lambda t, a: t + a) * -1 + 2 * areas[0]


def ring_centroid(ring: Column) -> Column:
    """Area centroid of a ring, as a point."""
    a = ring_area(ring)
    cross = lambda s: s[0][0] * s[1][1] - s[1][0] * s[0][1]
    along = lambda k: F.aggregate(segments(ring), F.lit(0.0), lambda t, s: t + (s[0][k] + s[1][k]) * cross(s)) / (6 * a)
    return F.array(along(0), along(1))


def mean_z(points: Column) -> Column:
    """Mean third coordinate of all points that have one; null without any."""
    zs = F.filter(F.transform(points, lambda p: F.try_element_at(p, F.lit(3))), lambda z: z.isNotNull())
    return F.when(F.size(zs) > 0, F.aggregate(zs, F.lit(0.0), lambda t, z: t + z) / F.size(zs))


def bounds(points: Column) -> Column:
    at = lambda k: F.transform(points, lambda p: p[k])
    return F.struct(F.array_min(at(0)).alias("xmin"), F.array_min(at(1)).alias("ymin"), F.array_max(at(0)).alias("xmax"), F.array_max(at(1)).alias("ymax"))


def point_in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Whether the point lies in the ring (even-odd rule; an edge belongs to the side above and to the left of it)."""

    def crosses(s: Column) -> Column:
        (x1, y1), (x2, y2) = (s[0][0], s[0][1]), (s[1][0], s[1][1])
        return F.when((y1 > y) != (y2 > y), F.when(x < (x2 - x1) * (y - y1) / (y2 - y1) + x1, 1).otherwise(0)).otherwise(0)

    return F.aggregate(segments(ring), F.lit(0), lambda t, s: t + crosses(s)) % 2 == 1


def point_in_polygon(x: Column, y: Column, rings: Column) -> Column:
    """In the polygon, its holes left out."""
    return F.aggregate(rings, F.lit(0), lambda t, r: t + F.when(point_in_ring(x, y, r), 1).otherwise(0)) % 2 == 1


def segment_distance(px: Column, py: Column, s: Column) -> Column:
    """Distance of a point from a segment."""
    ax, ay, bx, by = s[0][0], s[0][1], s[1][0], s[1][1]
    dx, dy = bx - ax, by - ay
    norm = dx * dx + dy * dy
    t = F.when(norm == 0, F.lit(0.0)).otherwise(F.least(F.greatest(((px - ax) * dx + (py - ay) * dy) / norm, F.lit(0.0)), F.lit(1.0)))
    return F.hypot(px - (ax + t * dx), py - (ay + t * dy))


def segment_crossing(s: Column, t: Column) -> Column:
    """The point where two segments cross; null where they do not or are parallel."""
    ax, ay, bx, by = s[0][0], s[0][1], s[1][0], s[1][1]
    cx, cy, dx, dy = t[0][0], t[0][1], t[1][0], t[1][1]
    den = (bx - ax) * (dy - cy) - (by - ay) * (dx - cx)
    u = ((cx - ax) * (dy - cy) - (cy - ay) * (dx - cx)) / F.nullif(den, F.lit(0.0))
    v = ((cx - ax) * (by - ay) - (cy - ay) * (bx - ax)) / F.nullif(den, F.lit(0.0))
    return F.when(u.between(0, 1) & v.between(0, 1), F.array(ax + u * (bx - ax), ay + u * (by - ay)))


def clip_ring(ring: Column, xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """The ring's part in a box (I. Sutherland, G. Hodgman, 1974), closed; its area is exact also where edges run back over one another."""

    def half(r: Column, inside, cross) -> Column:
        def step(s: Column) -> Column:
            a, b = s[0], s[1]
            return F.when(inside(a) & inside(b), F.array(b)).when(inside(a), F.array(cross(a, b))).when(inside(b), F.array(cross(a, b), b)).otherwise(F.slice(F.array(b), 2, 1))

        closed = lambda made: F.when(F.size(made) > 0, F.concat(made, F.slice(made, 1, 1))).otherwise(made)
        return let(r, lambda held: let(F.flatten(F.transform(segments(held), step)), closed))

    at_x = lambda x: lambda a, b: F.array(x.cast("double"), a[1] + (b[1] - a[1]) * (x - a[0]) / (b[0] - a[0]))
    at_y = lambda y: lambda a, b: F.array(a[0] + (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]), y.cast("double"))
    ring = half(ring, lambda p: p[0] >= xmin, at_x(xmin))
    ring = half(ring, lambda p: p[0] <= xmax, at_x(xmax))
    ring = half(ring, lambda p: p[1] >= ymin, at_y(ymin))
    return half(ring, lambda p: p[1] <= ymax, at_y(ymax))


def box_ring(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    return F.array(*[F.array(x.cast("double"), y.cast("double")) for x, y in ((xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax), (xmin, ymin))])


def area_in_box(parts: Column, xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """Area that a ring, given as its ``segments``, has in a box: the signed areas under its segments, cut to the box, without making the part.

    What cancels out can leave a rest of rounding in place of 0.
    """
    high = ymax - ymin
    inside = lambda v, top: F.least(F.greatest(v, F.lit(0.0)), top)
    above = lambda v: F.greatest(v - high, F.lit(0.0))

    def under(s: Column) -> Column:
        ax, ay, bx, by = s[0][0], s[0][1], s[1][0], s[1][1]

        def cut(p: Column) -> Column:  # the segment's ends in the box's strip, from its lower left
            u0, u1, v0, v1 = p[0], p[1], p[2], p[3]
            h0, h1, dv = inside(v0, high), inside(v1, high), F.abs(v1 - v0)
            mean = F.when(dv == 0, h0).otherwise((F.abs(h1 - h0) * (h0 + h1) / 2 + high * F.abs(above(v1) - above(v0))) / dv)
            return (u1 - u0) * F.when((v0 >= high) & (v1 >= high), high).when((v0 <= 0) & (v1 <= 0), 0.0).otherwise(mean)

        u0, u1 = inside(ax - xmin, xmax - xmin), inside(bx - xmin, xmax - xmin)
        at = lambda u, x, y: F.when(u == x - xmin, y - ymin).otherwise(ay - ymin + (by - ay) * (u - (ax - xmin)) / (bx - ax))
        return F.when((ax == bx) | (u0 == u1), 0.0).otherwise(let(F.array(u0, u1, at(u0, ax, ay), at(u1, bx, by)), cut))

    return F.abs(F.aggregate(parts, F.lit(0.0), lambda t, s: t + under(s)))


def overlay_polygons(df: DataFrame, res: int, ring: str = "ring") -> DataFrame:
    """Polygons (one ring) cut by the grid: a row for each cell (cx, cy) they share an area with, with that area."""
    from gridloom.operators.grid import cells_of_box
    from gridloom.plans.shared import tasks

    df = df.repartition(tasks(df.sparkSession))  # a small file holds many polygons, each of many cells
    boxed = df.withColumns({"__b": bounds(F.col(ring)), "__s": segments(F.col(ring))}).select("*", *[F.col(f"__b.{c}").alias(f"__{c}") for c in ("xmin", "ymin", "xmax", "ymax")])
    cells = cells_of_box(boxed, res, ("__xmin", "__ymin", "__xmax", "__ymax")).drop("__b", "__xmin", "__ymin", "__xmax", "__ymax")
    box = (F.col("cx"), F.col("cy"), F.col("cx") + res, F.col("cy") + res)
    found = cells.withColumn("area", area_in_box(F.col("__s"), *[c.cast("double") for c in box])).drop("__s")
    # what is next to nothing may be a rest of rounding: the clipped ring tells
    exact = F.when(F.col("area") > 1e-6 * res * res, F.col("area")).otherwise(F.abs(ring_area(clip_ring(F.col(ring), *box))))
    return found.withColumn("area", exact).where(F.col("area") > 0)


def vertex_count(kind: Column, polygons: Column) -> Column:
    """Vertices of the outer rings, each without its closing point; raises for other types than (multi)polygons."""
    outer = F.aggregate(polygons, F.lit(0), lambda t, rings: t + F.size(rings[0]) - 1)
    return F.when(kind.isin("Polygon", "MultiPolygon"), outer).otherwise(F.raise_error(F.concat(F.lit("no polygon: "), kind)))
