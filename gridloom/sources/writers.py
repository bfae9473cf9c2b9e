"""Sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.cells import cell_centre, cell_part
from gridloom.operators.grid import aggregate_cells, assign_tiles


def by_geometry_type(df: DataFrame, path: str, kind: str = "geom_type") -> None:
    df.write.mode("overwrite").partitionBy(kind).parquet(path)


def tiles(df: DataFrame, path: str, res: int, size: int, x0: int = 0, y0: int = 0) -> None:
    """Parquet by resolution and tile, for maps that read one tile at a time."""
    assign_tiles(df, res, size, x0, y0).withColumn("res", F.lit(res)).repartition("tx", "ty").write.mode("overwrite").partitionBy("res", "tx", "ty").parquet(path)


def missing_tiles(plan: DataFrame, done: DataFrame) -> DataFrame:
    """Tiles (tx, ty) of the plan that are not done: work goes on where it stopped."""
    return plan.join(done.select("tx", "ty").distinct(), ["tx", "ty"], "left_anti")


def csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("header", True).csv(path)


def cells_as_points(df: DataFrame, res: int, grd_id: str = "GRD_ID") -> DataFrame:
    """Cells as their centre points, ids taken apart."""
    x, y = cell_part(F.col(grd_id), "x"), cell_part(F.col(grd_id), "y")
    cx, cy = cell_centre(x, y, res)
    return df.withColumns({"x": cx, "y": cy}).drop(grd_id)


def all_formats(df: DataFrame, path: str, base: int, levels: list[int], aggs: dict) -> None:
    """The grid and its coarser levels, each as Parquet and CSV."""
    for level in [base, *levels]:
        cells = df if level == base else aggregate_cells(df, level, aggs)
        cells.write.mode("overwrite").parquet(f"{path}/grid_{level}.parquet")
        csv(cells, f"{path}/grid_{level}.csv")


def populated(parts: DataFrame, drop_empty: bool = True, number: str = "number") -> DataFrame:
    """Merged partitions with x and y in place of the id; without empty cells if asked."""
    rows = parts.where(F.col(number) > 0) if drop_empty else parts
    return rows.withColumns({"x": cell_part(F.col("GRD_ID"), "x"), "y": cell_part(F.col("GRD_ID"), "y")}).drop("GRD_ID")
