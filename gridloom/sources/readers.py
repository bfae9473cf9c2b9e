"""Sources."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def features(spark: SparkSession, path: str, box: tuple[float, float, float, float] | None = None, where: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """A Parquet layer, cut by a bounding box (overlap), a condition and columns; all three reach the scan."""
    df = spark.read.parquet(path)
    if box and {"xmin", "ymin", "xmax", "ymax"} <= set(df.columns):
        df = df.where((F.col("xmin") <= box[2]) & (F.col("xmax") >= box[0]) & (F.col("ymin") <= box[3]) & (F.col("ymax") >= box[1]))
    elif box:
        df = df.where(F.col("x").between(box[0], box[2]) & F.col("y").between(box[1], box[3]))
    df = df.where(where) if where else df
    return df.select(*columns) if columns else df


def csv_strings(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A CSV file with a header, every value a string."""
    return spark.read.option("header", True).option("sep", sep).option("inferSchema", False).csv(path)


def survey_points(spark: SparkSession, path: str) -> DataFrame:
    """(point_id, lat, lon) of a CSV without a usable header: rows of fewer than six fields and repeated headers are left out."""
    lines = spark.read.text(path).select(F.split("value", ",").alias("f")).where((F.size("f") >= 7) & ~F.startswith(F.col("f")[0], F.lit("POINT")))
    return lines.select(F.col("f")[0].alias("point_id"), F.col("f")[5].try_cast("double").alias("lat"), F.col("f")[6].try_cast("double").alias("lon"))


def folder(spark: SparkSession, path: str, suffix: str = "parquet") -> DataFrame:
    """All files of a folder, with the file's path as ``_file``."""
    glob = spark.read.option("pathGlobFilter", f"*.{suffix}")
    df = glob.parquet(path) if suffix == "parquet" else glob.option("header", True).csv(path)
    return df.withColumn("_file", F.input_file_name())


def union_sources(frames: dict[str, DataFrame], formats: dict[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Sources brought to one form each by their own function, one after another; copies stay."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [formats[name](df) for name, df in frames.items()])


def pixels(spark: SparkSession, path: str, box: tuple[float, float, float, float] | None = None, keep: Column | None = None, band: str = "value") -> DataFrame:
    """(x, y, value) of a pixel table in a box; no-data pixels left out."""
    df = spark.read.parquet(path).select("x", "y", F.col(band).alias("value")).where("value is not null")
    df = df.where(F.col("x").between(box[0], box[2]) & F.col("y").between(box[1], box[3])) if box else df
    return df.where(keep) if keep is not None else df


def sample_pixels(points: DataFrame, pixels: DataFrame, minx: float, maxy: float, res: float) -> DataFrame:
    """Points (x, y) with the value of the pixel (row, col, value) under them; null outside."""
    at = points.withColumns({"row": F.floor((F.lit(maxy) - F.col("y")) / res).cast("long"), "col": F.floor((F.col("x") - minx) / res).cast("long")})
    return at.join(pixels.select(F.col("row").cast("long"), F.col("col").cast("long"), "value"), ["row", "col"], "left").drop("row", "col")


def links(pages: DataFrame, html: str = "html", default: str = "default_download") -> DataFrame:
    """A row for each href of a page, with the file name at its end (``default`` where it has none)."""
    found = pages.withColumn("href", F.explode(F.regexp_extract_all(F.col(html), F.lit(r'href="([^"]*)"'), F.lit(1))))
    name = F.element_at(F.split(F.regexp_replace("href", r"[?#].*$", ""), "/"), -1)
    return found.withColumn("file_name", F.when(name == "", F.lit(default)).otherwise(name))
