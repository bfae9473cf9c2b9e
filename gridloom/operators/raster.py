"""Rasters as sparse pixel tables: a row for each pixel (x, y: lower-left corner), a column for each band, null for no data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.cells import pixel_corner, pixel_index, snap
from gridloom.operators.components import connected_components


def rename_bands(df: DataFrame, names: list[str]) -> DataFrame:
    bands = [c for c in df.columns if c not in ("x", "y")]
    if len(bands) != len(names):
        raise ValueError(f"{len(bands)} bands, {len(names)} names")
    return df.select("x", "y", *[F.col(b).alias(n) for b, n in zip(bands, names, strict=True)])


def combine_bands(bands: dict[str, DataFrame]) -> DataFrame:
    """Aligned one-band rasters (x, y, value) as one; pixels that only some have are null in the others."""
    return reduce(lambda a, b: a.join(b, ["x", "y"], "full"), [df.select("x", "y", F.col("value").alias(n)) for n, df in bands.items()])


def mask(df: DataFrame, covered: DataFrame, bands: list[str], invert: bool = False) -> DataFrame:
    """Null outside the covered pixels (x, y), or inside them."""
    marked = df.join(covered.select("x", "y").distinct().withColumn("__in", F.lit(True)), ["x", "y"], "left")
    inside = F.col("__in").isNull() if invert else F.col("__in").isNotNull()
    return marked.withColumns({b: F.when(inside, F.col(b)) for b in bands}).drop("__in")


def covered_by_boxes(pixels: DataFrame, boxes: DataFrame, res: int, all_touched: bool = True, bucket: int = 8) -> DataFrame:
    """Pixels in a box: touched by it, or with their centre in it. Boxes go to the buckets they cover, pixels have one."""
    step = res * bucket
    wide = boxes.withColumn("bx", F.explode(F.sequence(snap(F.col("xmin"), step) - step, snap(F.col("xmax"), step), F.lit(step).cast("long")))).withColumn("by", F.explode(F.sequence(snap(F.col("ymin"), step) - step, snap(F.col("ymax"), step), F.lit(step).cast("long"))))
    own = pixels.withColumns({"bx": snap(F.col("x"), step), "by": snap(F.col("y"), step)})
    if all_touched:
        hit = (F.col("x") < F.col("xmax")) & (F.col("x") + res > F.col("xmin")) & (F.col("y") < F.col("ymax")) & (F.col("y") + res > F.col("ymin"))
    else:
        cx, cy = F.col("x") + res / 2, F.col("y") + res / 2
        hit = (cx >= F.col("xmin")) & (cx < F.col("xmax")) & (cy >= F.col("ymin")) & (cy < F.col("ymax"))
    return own.join(wide, ["bx", "by"]).where(hit).drop("bx", "by")


def crop_extend(df: DataFrame, minx: int, miny: int, maxx: int, maxy: int, res: int, fill: Column | None = None) -> DataFrame:
    """Every pixel of the box, with the raster's values where it has some; fill elsewhere (default null)."""
    spark = df.sparkSession
    bands = [c for c in df.columns if c not in ("x", "y")]
    grid = spark.range(minx, maxx, res).withColumnRenamed("id", "x").withColumn("y", F.explode(F.sequence(F.lit(miny).cast("long"), F.lit(maxy - res).cast("long"), F.lit(res).cast("long"))))
    out = grid.join(df, ["x", "y"], "left")
    return out.withColumns({b: F.coalesce(F.col(b), fill) for b in bands}) if fill is not None else out


def to_rows(pixels: DataFrame, minx: int, maxy: int, res: int, keep: Column | None = None) -> DataFrame:
    """(row, col, value) pixels as (x, y, value) rows; no-data pixels are left out, others by ``keep``."""
    x, y = pixel_corner(F.col("row"), F.col("col"), minx, maxy, res)
    out = pixels.where(F.col("value").isNotNull()).select(x.cast("long").alias("x"), y.cast("long").alias("y"), "value")
    return out.where(keep) if keep is not None else out


def from_cells(cells: DataFrame, minx: int, maxy: int, res: int, width: int, height: int, value: str = "value", order: str | None = None, no_data: tuple = ()) -> DataFrame:
    """(row, col, value) of cells inside the raster; of two values for one pixel the last by ``order`` counts."""
    row, col = pixel_index(F.col("x"), F.col("y"), minx, maxy, res)
    held = cells.select(row.alias("row"), col.alias("col"), F.col(value).alias("value"), *([F.col(order).alias("__o")] if order else []))
    held = held.where(F.col("value").isNotNull() & ~F.isnan(F.col("value").cast("double")) & (F.col("row") >= 0) & (F.col("row") < height) & (F.col("col") >= 0) & (F.col("col") < width))
    if no_data:
        held = held.where(~F.col("value").isin(*no_data))
    return held.groupBy("row", "col").agg((F.max_by("value", "__o") if order else F.max("value")).alias("value"))


def zonal_stats(pixels: DataFrame, zones: DataFrame, zone_id: str, aggs: dict[str, Column], res: int, digits: int | None = None) -> DataFrame:
    """Aggregates of the pixels whose centre lies in a zone's box; zones without pixels have nulls."""
    found = covered_by_boxes(pixels, zones, res, all_touched=False).groupBy(zone_id).agg(*[a.alias(n) for n, a in aggs.items()])
    return zones.select(zone_id).join(found, zone_id, "left")


def zonal_class_sum(pixels: DataFrame, zones: DataFrame, zone_id: str, classes: dict[str, tuple[float, float]], res: int, value: str = "value", by: str = "class") -> DataFrame:
    """Per zone the sum of value over the pixels whose class value lies in [low, high]; ranges may overlap; 0 without any."""
    sums = [F.coalesce(F.sum(F.when(F.col(by).between(lo, hi), F.col(value))), F.lit(0)).cast("double").alias(n) for n, (lo, hi) in classes.items()]
    found = covered_by_boxes(pixels, zones, res, all_touched=False).groupBy(zone_id).agg(*sums)
    return zones.select(zone_id).join(found, zone_id, "left").select(zone_id, *[F.coalesce(F.col(n), F.lit(0.0)).alias(n) for n in classes])


def rasterise_boxes(boxes: DataFrame, res: int, value: str, order: str, all_touched: bool = False) -> DataFrame:
    """Pixels of boxes with the box's value; of several boxes on a pixel the last by ``order`` counts."""
    from gridloom.operators.grid import cells_of_box

    cells = cells_of_box(boxes, res)
    if not all_touched:
        px, py = F.col("cx") + res / 2, F.col("cy") + res / 2
        cells = cells.where((px >= F.col("xmin")) & (px < F.col("xmax")) & (py >= F.col("ymin")) & (py < F.col("ymax")))
    return cells.groupBy(F.col("cx").alias("x"), F.col("cy").alias("y")).agg(F.max_by(value, order).alias("value"))


def patches(pixels: DataFrame, res: int, least: float | None = None, equal: bool = True) -> DataFrame:
    """Pixels (value >= least) with their patch: connected by edges, of one value if ``equal``. A patch is named by its least pixel."""
    held = pixels.where(F.col("value") >= least) if least is not None else pixels.where(F.col("value").isNotNull())
    held = held.select("x", "y", "value", F.struct("y", "x").alias("node"))
    right = held.select((F.col("x") - res).alias("x"), "y", F.col("value").alias("v2"), F.col("node").alias("other"))
    above = held.select("x", (F.col("y") - res).alias("y"), F.col("value").alias("v2"), F.col("node").alias("other"))
    pairs = right.unionByName(above).join(held, ["x", "y"])
    pairs = pairs.where(F.col("value") == F.col("v2")) if equal else pairs
    labels = connected_components(pairs.select(F.col("node").alias("src"), F.col("other").alias("dst")))
    return held.join(labels, "node", "left").select("x", "y", "value", F.coalesce("component", "node").alias("patch"))
