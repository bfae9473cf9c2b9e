"""Cells: roll-up, pyramids, tiles, allocation, extent."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.functions.cells import half_even, snap

# Coarser resolutions by the resolution they are made from.
SCHEDULE = {100: (200, 500, 1000), 1000: (2000, 5000, 10000), 10000: (20000, 50000, 100000)}


def aggregate_cells(df: DataFrame, res: int, aggs: dict[str, Column], keys: tuple[str, ...] = ()) -> DataFrame:
    """Cells of ``res`` with the aggregates of the finer cells in them: one shuffle, partial sums first."""
    return df.groupBy(*keys, snap(F.col("x"), res).alias("x"), snap(F.col("y"), res).alias("y")).agg(*[a.alias(n) for n, a in aggs.items()])


def pyramid(df: DataFrame, levels: list[int], aggs: dict[str, Column], associative: bool = True) -> DataFrame:
    """All levels, with the column ``res``.

    associative: the aggregates are sums (or the like) under their own names, so a level is made from the
    one before if that divides it. Averages and medians are always made from the base cells.
    """
    out, made = [], {}
    for level in levels:
        base = max((m for m in made if level % m == 0), default=None) if associative else None
        made[level] = aggregate_cells(made[base] if base else df, level, aggs)
        out.append(made[level].select(F.lit(level).alias("res"), "x", "y", *aggs))
    return reduce(DataFrame.unionByName, out)


def ratio(num: Column, den: Column, whole: bool = False) -> Column:
    """num / den * 100; null where den is 0 or null. whole: cut to a whole number, as a raster of whole numbers holds it."""
    r = F.when(den != 0, num / den * 100)
    return r.cast("long") if whole else r


def resample(df: DataFrame, base: int, res: int, value: str = "value", how: str = "average") -> DataFrame:
    """Coarser pixels from base pixels; missing pixels do not count. res must be a multiple of base."""
    if res % base:
        raise ValueError(f"{res} is not a multiple of {base}")
    fn = {"average": F.avg, "sum": F.sum, "median": F.median}[how]
    return aggregate_cells(df.where(F.col(value).isNotNull()), res, {value: fn(value)})


def extent(df: DataFrame, res: int) -> DataFrame:
    return df.agg(F.min("x").alias("minx"), F.min("y").alias("miny"), (F.max("x") + res).alias("maxx"), (F.max("y") + res).alias("maxy"))


def crop(df: DataFrame, minx: int, miny: int, maxx: int, maxy: int) -> DataFrame:
    """Cells whose corner lies in the box, its edges included."""
    return df.where(F.col("x").between(minx, maxx) & F.col("y").between(miny, maxy))


def assign_tiles(df: DataFrame, res: int, size: int, x0: int = 0, y0: int = 0) -> DataFrame:
    """df with its tile (tx, ty) of size x size cells, and its column and row in the tile."""
    cx, cy = F.floor((F.col("x") - x0) / res), F.floor((F.col("y") - y0) / res)
    tx, ty = F.floor(cx / size), F.floor(cy / size)
    return df.withColumns({"tx": tx.cast("long"), "ty": ty.cast("long"), "col": (cx - tx * size).cast("long"), "row": (cy - ty * size).cast("long")})


def tile_bands(bands: dict[str, DataFrame], res: int, size: int, no_data: dict[str, list] | None = None) -> DataFrame:
    """Bands (x, y, value) of one grid as tile rows; a cell without data in every band is left out; values rounded half to even."""
    rows = None
    for name, band in bands.items():
        missing = (no_data or {}).get(name, [])
        v = F.when(~F.col("value").isin(*[m for m in missing if m is not None]), F.col("value")) if [m for m in missing if m is not None] else F.col("value")
        own = band.select("x", "y", half_even(v).alias(name)).where(F.col(name).isNotNull())
        rows = own if rows is None else rows.join(own, ["x", "y"], "full")
    return assign_tiles(rows, res, size)


def allocate(children: DataFrame, parents: DataFrame, keys: list[str], area: str, total: str, digits: int = 2) -> DataFrame:
    """Children with their share of the parent's total by area; children without area get 0, children without a parent null."""
    whole = F.sum(area).over(Window.partitionBy(*keys))
    joined = children.join(parents.select(*keys, total), keys, "left").withColumn("__whole", whole)
    share = F.when(F.col("__whole") > 0, half_even(F.col(total) * F.col(area) / F.col("__whole"), digits)).otherwise(F.when(F.col(total).isNotNull(), F.lit(0.0)))
    return joined.withColumn("allocated", share).drop("__whole")


def allocate_grouped(children: DataFrame, parents: DataFrame, keys: list[str], area: str, total: str, digits: int = 2) -> DataFrame:
    """``allocate`` by aggregate and join: for parents with very many children, which a window would put in one task."""
    whole = children.groupBy(*keys).agg(F.sum(area).alias("__whole")).join(parents.select(*keys, total), keys, "left")
    share = F.when(F.col("__whole") > 0, half_even(F.col(total) * F.col(area) / F.col("__whole"), digits)).otherwise(F.when(F.col(total).isNotNull(), F.lit(0.0)))
    return children.join(whole, keys, "left").withColumn("allocated", share).drop("__whole")


def cells_of_box(df: DataFrame, res: int, box: tuple[str, str, str, str] = ("xmin", "ymin", "xmax", "ymax")) -> DataFrame:
    """A row for each cell (cx, cy) that the box touches with some area; half-open, so a box ending on an edge stops there."""
    xmin, ymin, xmax, ymax = (F.col(c) for c in box)
    last = lambda lo, hi: F.greatest(snap(lo, res), F.when(hi % res == 0, snap(hi, res) - res).otherwise(snap(hi, res))).cast("long")
    step = F.lit(res).cast("long")
    wide = df.withColumn("cx", F.explode(F.sequence(snap(xmin, res), last(xmin, xmax), step)))
    return wide.withColumn("cy", F.explode(F.sequence(snap(ymin, res), last(ymin, ymax), step)))


def neighbours(df: DataFrame, bx: str = "bx", by: str = "by") -> DataFrame:
    """df with its bucket and the eight around it."""
    around = F.array(*[F.struct((F.col(bx) + i).alias("x"), (F.col(by) + j).alias("y")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    return df.withColumn("__n", F.explode(around)).withColumns({bx: F.col("__n.x"), by: F.col("__n.y")}).drop("__n")


def point_counts(points: DataFrame, levels: list[int], rounded_to: int = 10) -> DataFrame:
    """(res, x, y, n): points by cell at several resolutions, their coordinates rounded first."""
    digits = -(len(str(rounded_to)) - 1)
    near = points.select(half_even(F.col("x").cast("double"), digits).alias("x"), half_even(F.col("y").cast("double"), digits).alias("y")).dropna()
    return pyramid(near.withColumn("n", F.lit(1)), levels, {"n": F.sum("n")})


def dense_codes(labels: DataFrame, name: str, code: str = "code") -> DataFrame:
    """A whole number from 1 for each distinct label, in the labels' order.

    Numbers come from a range sort and one count for each partition, so labels are never gathered in one task.
    """
    from gridloom.plans.shared import keep

    held = keep(labels.select(name).distinct().orderBy(name).withColumn("__part", F.spark_partition_id()), "codes")
    base = held.groupBy("__part").agg(F.count("*").alias("n"), F.min(name).alias("first"))
    before = base.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # a row for each partition
    rank = F.row_number().over(Window.partitionBy("__part").orderBy(name))
    return held.join(F.broadcast(before.select("__part", "before")), "__part").select(name, (rank + F.col("before")).cast("long").alias(code))
