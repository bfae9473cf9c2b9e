"""Lines against lines and rings: crossings by bucketed segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.geometry import segment_crossing, segments
from gridloom.operators.spatial import spread


def line_segments(lines: DataFrame, line: str = "line", name: str = "id") -> DataFrame:
    """(id, place, s) and the segment's box."""
    rows = lines.select(F.col(name).alias("id"), F.posexplode(segments(F.col(line))).alias("place", "s"))
    s = F.col("s")
    return rows.select("id", "place", "s", F.least(s[0][0], s[1][0]).alias("xmin"), F.least(s[0][1], s[1][1]).alias("ymin"), F.greatest(s[0][0], s[1][0]).alias("xmax"), F.greatest(s[0][1], s[1][1]).alias("ymax"))


def crossings(a: DataFrame, b: DataFrame, size: float) -> DataFrame:
    """(a, b, x, y): the distinct points where lines of two tables (id, line) cross."""
    left = spread(line_segments(a), size).select("bx", "by", F.col("id").alias("a"), F.col("s").alias("sa"))
    right = spread(line_segments(b), size).select("bx", "by", F.col("id").alias("b"), F.col("s").alias("sb"))
    met = left.join(right, ["bx", "by"]).withColumn("p", segment_crossing(F.col("sa"), F.col("sb"))).where("p is not null")
    return met.select("a", "b", F.round(F.col("p")[0], 6).alias("x"), F.round(F.col("p")[1], 6).alias("y")).dropDuplicates()


def box_ring_crossings(lines: DataFrame, boxes: DataFrame, distance: float, size: float) -> DataFrame:
    """Points where lines cross the outline of boxes grown by a distance (square corners)."""
    from gridloom.functions.geometry import box_ring

    rings = boxes.select("id", box_ring(F.col("xmin") - distance, F.col("ymin") - distance, F.col("xmax") + distance, F.col("ymax") + distance).alias("line"))
    return crossings(lines, rings, size)


def path_line(path: DataFrame, position: str = "position", x: str = "x", y: str = "y", keys: tuple[str, ...] = ()) -> DataFrame:
    """Nodes in order as a line."""
    held = F.array_sort(F.collect_list(F.struct(F.col(position).alias("o"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))))
    return path.groupBy(*keys).agg(F.transform(held, lambda p: F.array(p["x"], p["y"])).alias("line"))
