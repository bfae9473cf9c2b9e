"""Checks of tessellations: (description, type, x, y) issues, distinct."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.geometry import bounds, point_distance, ring_area, ring_centroid, segment_crossing, segment_distance, segments
from gridloom.operators.spatial import overlapping, spread
from gridloom.plans.shared import meet, tasks


def _segments(polygons: DataFrame) -> DataFrame:
    rows = polygons.select("id", F.posexplode("rings").alias("ring", "r")).select("id", "ring", F.posexplode(segments(F.col("r"))).alias("i", "s"), (F.size("r") - 1).alias("n"))
    return rows.select("id", "ring", "i", "n", "s", F.least(F.col("s")[0][0], F.col("s")[1][0]).alias("xmin"), F.least(F.col("s")[0][1], F.col("s")[1][1]).alias("ymin"), F.greatest(F.col("s")[0][0], F.col("s")[1][0]).alias("xmax"), F.greatest(F.col("s")[0][1], F.col("s")[1][1]).alias("ymax"))


def _issue(df: DataFrame, said, kind: str, x, y) -> DataFrame:
    return df.select(said.alias("description"), F.lit(kind).alias("type"), x.cast("double").alias("x"), y.cast("double").alias("y"))


def micro_segments(polygons: DataFrame, t: float = 0.1) -> DataFrame:
    """Segments shorter than t, at their middle."""
    s = F.col("s")
    short = _segments(polygons).where(point_distance(s[0], s[1]) < t)
    return _issue(short, F.concat(F.lit("length="), point_distance(s[0], s[1]).cast("string")), "micro_segment", (s[0][0] + s[1][0]) / 2, (s[0][1] + s[1][1]) / 2)


def self_crossings(polygons: DataFrame, size: float) -> DataFrame:
    """Polygons with two segments that cross other than as neighbours at their shared point."""
    wide = spread(_segments(polygons), size)
    a = wide.select("bx", "by", "id", F.col("ring").alias("ra"), F.col("i").alias("ia"), F.col("s").alias("sa"), "n")
    b = wide.select("bx", "by", "id", F.col("ring").alias("rb"), F.col("i").alias("ib"), F.col("s").alias("sb"))
    step = F.abs(F.col("ia") - F.col("ib"))
    neighbours = (F.col("ra") == F.col("rb")) & ((step == 1) | (step == F.col("n") - 1))
    met = meet(a, b, ["bx", "by", "id"]).where((F.struct("ra", "ia") < F.struct("rb", "ib")) & ~neighbours).withColumn("p", segment_crossing(F.col("sa"), F.col("sb"))).where("p is not null")
    return _issue(met, F.concat(F.lit("self-intersection of "), F.col("id").cast("string")), "validity", F.col("p")[0], F.col("p")[1])


def overlaps(boxes: DataFrame, size: float) -> DataFrame:
    """Overlaps of box polygons, at the middle of the overlap."""
    pairs = overlapping(boxes, size, middle=True)
    return _issue(pairs, F.concat(F.lit("area="), F.col("area").cast("string")), "intersection", F.col("x"), F.col("y"))


def noding(polygons: DataFrame, size: float, t: float = 0.1, own_box_only: bool = False) -> DataFrame:
    """Vertices nearer than t to a segment without touching it; own_box_only keeps to the segment's own box (a known reading)."""
    n, s = tasks(polygons.sparkSession), F.col("s")
    segs = _segments(polygons).select("xmin", "ymin", "xmax", "ymax", *[s[i][j].alias(n) for n, i, j in (("x1", 0, 0), ("y1", 0, 1), ("x2", 1, 0), ("y2", 1, 1))])
    # most of a wide bucket's pairs are far apart: buckets of about half a segment, if that is less
    mean = segs.agg(F.avg(F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")))).first()[0]
    size = min(size, max(2 * t, (mean or size) / 2))
    points = segs.select(F.col("x1").alias("px"), F.col("y1").alias("py")).withColumns({"bx": F.floor(F.col("px") / size), "by": F.floor(F.col("py") / size)})
    points = points.repartition(n, "bx", "by").distinct()
    d = segment_distance(F.col("px"), F.col("py"), F.array(F.array("x1", "y1"), F.array("x2", "y2")))
    met = spread(segs, size, t).repartition(n, "bx", "by").hint("merge").join(points, ["bx", "by"]).withColumn("d", d).where((F.col("d") > 0) & (F.col("d") <= t))
    if own_box_only:
        met = met.where(F.col("px").between(F.col("xmin"), F.col("xmax")) & F.col("py").between(F.col("ymin"), F.col("ymax")))
    met = met.select("bx", "by", "px", "py", "d").distinct()  # within a bucket, without another shuffle
    return _issue(met, F.concat(F.lit("distance="), F.col("d").cast("string")), "noding", F.col("px"), F.col("py"))


def thin_boxes(boxes: DataFrame, t: float = 0.1) -> DataFrame:
    """Box polygons that shrinking by t leaves empty: exact for boxes."""
    return _issue(boxes.where((F.least(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"))) <= 2 * t), F.lit("thin polygon"), "thin polygon", (F.col("xmin") + F.col("xmax")) / 2, (F.col("ymin") + F.col("ymax")) / 2)


def slivers(polygons: DataFrame, t: float = 0.1) -> DataFrame:
    """Polygons whose area is small against their outline: area < t * half the outline, an estimate of shrinking by t for long thin shapes."""
    outline = F.aggregate(segments(F.col("rings")[0]), F.lit(0.0), lambda a, s: a + point_distance(s[0], s[1]))
    thin = polygons.where(F.abs(ring_area(F.col("rings")[0])) < outline / 2 * t)
    centre = ring_centroid(F.col("rings")[0])
    b = bounds(F.col("rings")[0])
    return _issue(thin, F.lit("thin polygon part"), "thin_polygon_part", F.coalesce(centre[0], b["xmin"]), F.coalesce(centre[1], b["ymin"]))


def unexpected_type(features: DataFrame, expected: str, kind: str = "geom_type") -> DataFrame:
    """The first feature of another type, if any."""
    return features.where(F.col(kind) != expected).orderBy("id").limit(1)


def all_issues(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).dropDuplicates()
