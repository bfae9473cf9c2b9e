"""Joins by place. Candidates always come from an equi-join on buckets; the exact test follows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.functions.cells import half_even, snap
from gridloom.operators.grid import neighbours
from gridloom.plans.shared import keep, meet

#: Ids of a place that go into one list, about.
IDS = 1000


def bucketed(df: DataFrame, size: float, x: str = "x", y: str = "y") -> DataFrame:
    return df.withColumns({"bx": F.floor(F.col(x) / size).cast("long"), "by": F.floor(F.col(y) / size).cast("long")})


def spread(boxes: DataFrame, size: float, reach: float = 0) -> DataFrame:
    """Boxes (xmin, ymin, xmax, ymax), a row for each bucket they reach."""
    lo = lambda c: F.floor((F.col(c) - reach) / size).cast("long")
    hi = lambda c: F.floor((F.col(c) + reach) / size).cast("long")
    return boxes.withColumn("bx", F.explode(F.sequence(lo("xmin"), hi("xmax")))).withColumn("by", F.explode(F.sequence(lo("ymin"), hi("ymax"))))


def box_distance2(px, py) -> F.Column:
    """Squared distance of a point from the box columns."""
    dx = F.greatest(F.col("xmin") - px, F.lit(0), px - F.col("xmax"))
    dy = F.greatest(F.col("ymin") - py, F.lit(0), py - F.col("ymax"))
    return dx * dx + dy * dy


def radius_sum(points: DataFrame, radius: float, value: str, match: list[str] | None = None, name: str = "nearby") -> DataFrame:
    """Points (id, x, y) with the rounded sum of ``value`` over the points within the radius (themselves included), of equal ``match`` columns.

    Cells much smaller than the radius have many neighbours; values are therefore summed by place first.
    """
    match = match or []
    places = points.groupBy(*match, "x", "y").agg(F.sum(value).alias("v"))
    here = bucketed(points.select("id", *match, "x", "y"), radius)
    there = neighbours(bucketed(places.withColumnsRenamed({"x": "x2", "y": "y2"}), radius, "x2", "y2"))
    near = (F.col("x") - F.col("x2")) ** 2 + (F.col("y") - F.col("y2")) ** 2 <= radius * radius
    return here.join(there, [*match, "bx", "by"]).where(near).groupBy("id").agg(half_even(F.sum("v")).cast("long").alias(name))


def points_in_boxes(points: DataFrame, boxes: DataFrame, size: float, how: str = "left") -> DataFrame:
    """Points (x, y) with the boxes that contain them strictly; without one they stay (left) with nulls."""
    inside = (F.col("x") > F.col("xmin")) & (F.col("x") < F.col("xmax")) & (F.col("y") > F.col("ymin")) & (F.col("y") < F.col("ymax"))
    here = bucketed(points.withColumn("__p", F.monotonically_increasing_id()), size) if how == "left" else bucketed(points, size)
    hits = here.join(spread(boxes, size), ["bx", "by"]).where(inside)
    if how != "left":
        return hits.drop("bx", "by")
    here = bucketed(points, size)
    wide = spread(boxes, size)
    cond = (here["bx"] == wide["bx"]) & (here["by"] == wide["by"]) & (here["x"] > wide["xmin"]) & (here["x"] < wide["xmax"]) & (here["y"] > wide["ymin"]) & (here["y"] < wide["ymax"])
    return here.join(wide, cond, "left").drop("bx", "by")


def nearest(points: DataFrame, targets: DataFrame, size: float, limit: float | None = None, max_rounds: int = 40) -> DataFrame:
    """Points (id, x, y) with their nearest target (target id, tx, ty, distance); ties go to the least target id.

    Buckets double in size from round to round. A hit counts once it is no further than the bucket is wide,
    since nothing nearer can lie outside the nine buckets. Points without a target within ``limit`` are left out.
    """
    left = points.select("id", "x", "y")
    aims = targets.select(F.col("id").alias("target"), F.col("x").alias("tx"), F.col("y").alias("ty"))
    found = None
    if not aims.limit(1).count():
        return left.limit(0).select("id", "x", "y", F.lit(None).cast("long").alias("target"), F.lit(None).cast("double").alias("tx"), F.lit(None).cast("double").alias("ty"), F.lit(None).cast("double").alias("distance"))
    for _ in range(max_rounds):
        here = bucketed(left, size)
        there = neighbours(bucketed(aims, size, "tx", "ty"))
        d2 = (F.col("x") - F.col("tx")) ** 2 + (F.col("y") - F.col("ty")) ** 2
        best = here.join(there, ["bx", "by"]).withColumn("d2", d2).groupBy("id", "x", "y").agg(F.min(F.struct("d2", "target", "tx", "ty")).alias("b"))
        best = keep(best.where(F.col("b.d2") <= size * size).select("id", "x", "y", "b.target", "b.tx", "b.ty", F.sqrt("b.d2").alias("distance")), "nearest")
        found = best if found is None else found.unionByName(best)
        left = keep(left.join(best.select("id"), "id", "left_anti"), "unplaced")
        if not left.limit(1).count() or (limit is not None and size >= limit):
            break
        size *= 2
    return found.where(F.col("distance") <= limit) if limit is not None else found


def nearest_boxes(points: DataFrame, boxes: DataFrame, size: float, within: float) -> DataFrame:
    """Points (id, x, y) with all boxes (box) at the least distance up to ``within``; ties give several rows; none gives nulls."""
    here = bucketed(points.select("id", "x", "y"), size)
    there = spread(boxes, size, within)
    met = here.join(there, ["bx", "by"]).withColumn("distance", F.sqrt(box_distance2(F.col("x"), F.col("y")))).where(F.col("distance") <= within)
    first = met.groupBy("id").agg(F.min("distance").alias("distance"))
    tied = met.join(first, ["id", "distance"]).select("id", "box", "distance")
    return points.select("id").join(tied, "id", "left")


def codes_within(cells: DataFrame, regions: DataFrame, res: int, distance: float, size: float) -> DataFrame:
    """Cells (id, x, y) with the sorted, '-'-joined codes of the region boxes within a distance of them; '' without any."""
    here = spread(cells.select("id", "x", "y", F.col("x").alias("xmin"), F.col("y").alias("ymin"), (F.col("x") + res).alias("xmax"), (F.col("y") + res).alias("ymax")), size).drop("xmin", "ymin", "xmax", "ymax")
    there = spread(regions.select("code", "xmin", "ymin", "xmax", "ymax"), size, distance)
    dx = F.greatest(F.col("xmin") - (F.col("x") + res), F.lit(0), F.col("x") - F.col("xmax"))
    dy = F.greatest(F.col("ymin") - (F.col("y") + res), F.lit(0), F.col("y") - F.col("ymax"))
    met = here.join(there, ["bx", "by"]).where(dx * dx + dy * dy <= distance * distance)
    codes = met.groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("code")), "-").alias("codes"))
    return cells.select("id").join(codes, "id", "left").select("id", F.coalesce("codes", F.lit("")).alias("codes"))


def _gathered(points: DataFrame, name: str) -> DataFrame:
    """(x, y, part, parts, name): the ids of each place, in lists of about IDS."""
    parts = F.ceil(F.count("*") / IDS).cast("long").alias("parts")
    held = points.join(points.groupBy("x", "y").agg(parts).hint("merge"), ["x", "y"])
    return held.groupBy("x", "y", F.pmod(F.xxhash64("id"), F.col("parts")).alias("part"), "parts").agg(F.collect_list("id").alias(name))


def pairs_within(a: DataFrame, b: DataFrame, distance: float) -> DataFrame:
    """Pairs (a, b, distance) of points (id, x, y) at most a distance apart.

    Places are met, not points: a place of n points by one of m takes one test for its n * m pairs, which are
    written out of lists of ids, list by list, so that a place of very many points is no task of its own.
    """
    here, there = _gathered(a.select("id", "x", "y"), "a"), _gathered(b.select("id", F.col("x"), F.col("y")), "b")
    sites = bucketed(here.select("x", "y", "parts").distinct(), distance)
    there = there.withColumnsRenamed({"x": "x2", "y": "y2"}).drop("part", "parts")
    d = F.sqrt((F.col("x") - F.col("x2")) ** 2 + (F.col("y") - F.col("y2")) ** 2)
    near = meet(sites, neighbours(bucketed(there, distance, "x2", "y2")), ["bx", "by"]).withColumn("distance", d).where(F.col("distance") <= distance)
    near = near.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    key = F.concat_ws(" ", "x", "y", "part").alias("key")  # joins on doubles are dealt anew, by size
    met = meet(near.select(key, "b", "distance"), here.select(key, "a"), ["key"])
    return met.select(F.explode("a").alias("a"), "b", "distance").select("a", F.explode("b").alias("b"), "distance")


def near_other_group(points: DataFrame, group: str, distance: float) -> DataFrame:
    """Points (id, x, y, group) with the distance of the nearest point of another group up to ``distance``; null without one."""
    here = bucketed(points.select("id", "x", "y", F.col(group).alias("g")), distance)
    there = neighbours(bucketed(points.select(F.col("x").alias("x2"), F.col("y").alias("y2"), F.col(group).alias("g2")), distance, "x2", "y2"))
    d2 = (F.col("x") - F.col("x2")) ** 2 + (F.col("y") - F.col("y2")) ** 2
    best = here.join(there, ["bx", "by"]).where((F.col("g") != F.col("g2")) & (d2 <= distance * distance)).groupBy("id").agg(F.sqrt(F.min(d2)).alias("distance"))
    return points.select("id", group).join(best, "id", "left")


def overlapping(boxes: DataFrame, size: float, middle: bool = False) -> DataFrame:
    """Pairs (a > b) of boxes (id) whose overlap has an area; with its middle (x, y) if asked. A pair that shares several buckets is found once, in its first."""
    wide = spread(boxes.select("id", "xmin", "ymin", "xmax", "ymax"), size)
    a = wide.select("bx", "by", F.col("id").alias("a"), *[F.col(c).alias(f"a{c}") for c in ("xmin", "ymin", "xmax", "ymax")])
    b = wide.select("bx", "by", F.col("id").alias("b"), *[F.col(c).alias(f"b{c}") for c in ("xmin", "ymin", "xmax", "ymax")])
    x1, y1, x2, y2 = F.greatest("axmin", "bxmin"), F.greatest("aymin", "bymin"), F.least("axmax", "bxmax"), F.least("aymax", "bymax")
    w, h = x2 - x1, y2 - y1
    first = (F.col("bx") == F.floor(x1 / size)) & (F.col("by") == F.floor(y1 / size))
    centre = [((x1 + x2) / 2).alias("x"), ((y1 + y2) / 2).alias("y")] if middle else []
    return meet(a, b, ["bx", "by"]).where((F.col("a") > F.col("b")) & (w > 0) & (h > 0) & first).select("a", "b", (w * h).alias("area"), *centre)


def overlay_cells(boxes: DataFrame, res: int) -> DataFrame:
    """Parts of boxes in each cell they share an area with: the columns of boxes, cx, cy, area."""
    from gridloom.operators.grid import cells_of_box

    w = F.least(F.col("xmax"), F.col("cx") + res) - F.greatest("xmin", "cx")
    h = F.least(F.col("ymax"), F.col("cy") + res) - F.greatest("ymin", "cy")
    return cells_of_box(boxes, res).withColumn("area", w * h).where(F.col("area") > 0)


def first_per_key(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """A lookup: the last value of each key by ``order``."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))


def rank_within(df: DataFrame, key: str, order: list, k: int, name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col(name) <= k)


def lookup(df: DataFrame, table: DataFrame, key: str, value: str, default) -> DataFrame:
    """df with the table's value by key; the default where the key is absent."""
    return df.join(table.select(key, value), key, "left").withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def snap_to_multiple(df: DataFrame, step: int) -> DataFrame:
    return df.withColumns({"x": snap(F.col("x"), step), "y": snap(F.col("y"), step)})
