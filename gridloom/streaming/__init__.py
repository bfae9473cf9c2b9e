"""Grids of event streams. Nothing of the sort is asked for by the batch operators; these run them on arriving rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.cells import snap


def windowed_cells(events: DataFrame, res: int, window: str, late: str, aggs: dict[str, Column], ts: str = "ts") -> DataFrame:
    """Cells by time window; rows later than ``late`` are left out of windows already closed. Works on batches too."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, window), snap(F.col("x"), res).alias("x"), snap(F.col("y"), res).alias("y")).agg(*[a.alias(n) for n, a in aggs.items()])
