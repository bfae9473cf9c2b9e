"""Sums over a disc of cells around each cell.

The disc of radius r (in cells) is 2r + 1 horizontal runs. Each cell that has a value
is sent to the tiles its disc reaches; a tile with its halo is summed from running
sums along rows, two look-ups for each run. A tile's memory is fixed by its size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def disc(r: int) -> list[tuple[int, int]]:
    """(row offset, half width) of the runs of a disc."""
    return [(dy, int((r * r - dy * dy) ** 0.5 + 1e-9)) for dy in range(-r, r + 1)]


def focal_sum(cells: DataFrame, res: int, radius: float, value: str = "value", code: str | None = None, only_cells: bool = True, tile: int = 256) -> DataFrame:
    """(x, y[, code], focal): sum over the cells whose centre is within the radius (in whole cells), of the same code if given.

    Null and negative values count 0. With only_cells the result has the given cells, else every cell of the discs.
    """
    r = int(radius / res)
    runs = disc(r)
    group = F.col(code).cast("long") if code else F.lit(0).cast("long")
    cx, cy = F.floor(F.col("x") / res), F.floor(F.col("y") / res)
    base = cells.select(cx.cast("long").alias("cx"), cy.cast("long").alias("cy"), group.alias("code"), F.greatest(F.coalesce(F.col(value).cast("double"), F.lit(0.0)), F.lit(0.0)).alias("v"))
    base = base.where("code is not null").groupBy("cx", "cy", "code").agg(F.sum("v").alias("v"))
    lo = lambda c: F.floor((F.col(c) - r) / tile).cast("long")
    hi = lambda c: F.floor((F.col(c) + r) / tile).cast("long")
    dealt = base.withColumn("tx", F.explode(F.sequence(lo("cx"), hi("cx")))).withColumn("ty", F.explode(F.sequence(lo("cy"), hi("cy"))))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        tx, ty, own_code = (k.as_py() for k in key)
        side = tile + 2 * r
        x0, y0 = tx * tile - r, ty * tile - r
        x, y, v = (table.column(n).to_numpy() for n in ("cx", "cy", "v"))
        grid = np.zeros((side, side))
        grid[y - y0, x - x0] = v
        total = np.zeros((side, side + 1))
        np.cumsum(grid, axis=1, out=total[:, 1:])
        out = np.zeros((tile, tile))
        for dy, half in runs:
            rows = total[r + dy : r + dy + tile]
            out += rows[:, r + half + 1 : r + half + 1 + tile] - rows[:, r - half : r - half + tile]
        if only_cells:
            inside = (x >= tx * tile) & (x < (tx + 1) * tile) & (y >= ty * tile) & (y < (ty + 1) * tile)
            px, py = x[inside], y[inside]
        else:
            py, px = np.nonzero(np.abs(out) > 1e-9)
            px, py = px + tx * tile, py + ty * tile
        return pa.table({"x": px * res, "y": py * res, "code": np.full(len(px), own_code, np.int64), "focal": out[py - ty * tile, px - tx * tile]})

    made = dealt.groupBy("tx", "ty", "code").applyInArrow(run, "x long, y long, code long, focal double")
    return made if code else made.drop("code")


def focal_sum_small(cells: DataFrame, res: int, radius: float, value: str = "value", code: str | None = None) -> DataFrame:
    """``focal_sum`` for a radius of a few cells: each cell is sent to its disc's offsets and summed; no Python."""
    r = int(radius / res)
    offsets = F.array(*[F.struct(F.lit(dx * res).alias("dx"), F.lit(dy * res).alias("dy")) for dy, half in disc(r) for dx in range(-half, half + 1)])
    keys = [code] if code else []
    base = cells.groupBy(*keys, "x", "y").agg(F.sum(F.greatest(F.coalesce(F.col(value), F.lit(0)), F.lit(0))).alias("v"))
    sent = base.where("v > 0").withColumn("o", F.explode(offsets)).select(*keys, (F.col("x") + F.col("o.dx")).alias("x"), (F.col("y") + F.col("o.dy")).alias("y"), "v")
    return base.select(*keys, "x", "y").join(sent.groupBy(*keys, "x", "y").agg(F.sum("v").alias("focal")), [*keys, "x", "y"], "left").withColumn("focal", F.coalesce("focal", F.lit(0)))
