"""Classes of cells for maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def trivariate_class(parts: list[Column], centre: tuple[float, float, float] = (1 / 3, 1 / 3, 1 / 3), coefficient: float | None = None) -> Column:
    """``0 1 2`` (one share prevails), ``m0 m1 m2`` (one share is low), ``center`` or ``unknown``; null without a total.

    With a coefficient, cells near the centre (shrunk towards the corners by it) are ``center``.
    """
    total = F.coalesce(parts[0], F.lit(0)) + F.coalesce(parts[1], F.lit(0)) + F.coalesce(parts[2], F.lit(0))
    s = [F.coalesce(p, F.lit(0)) / total for p in parts]
    c = [F.lit(float(v)) for v in centre]
    inner = None if coefficient is None else 1 - coefficient

    def prevails(i: int) -> Column:
        j, k = (n for n in range(3) if n != i)
        if inner is None:
            return F.lit(str(i))
        near = (s[k] - c[k]) * (c[j] - inner * c[j]) >= (s[j] - inner * c[j]) * (inner * c[k] - c[k])
        return F.when(near, "center").otherwise(str(i))

    def mixed(i: int) -> Column:
        return F.lit(f"m{i}") if inner is None else F.when(s[i] > inner * c[i], "center").otherwise(f"m{i}")

    def others(i: int) -> list[int]:
        return [n for n in range(3) if n != i]

    out = F.when(total == 0, F.lit(None).cast("string"))
    for i in range(3):
        j, k = others(i)
        out = out.when((s[i] >= c[i]) & (s[j] <= c[j]) & (s[k] <= c[k]), prevails(i))
    for i in range(3):
        j, k = others(i)
        out = out.when((s[i] <= c[i]) & (s[j] >= c[j]) & (s[k] >= c[k]), mixed(i))
    return out.otherwise("unknown")


def without_mixed(cls: Column, parts: list[Column]) -> Column:
    """The class with m0, m1, m2 replaced by the larger of the other two shares; on a tie 2, 2, 0."""
    return F.when(cls == "m0", F.when(parts[1] > parts[2], "1").otherwise("2")).when(cls == "m1", F.when(parts[0] > parts[2], "0").otherwise("2")).when(cls == "m2", F.when(parts[1] > parts[0], "1").otherwise("0")).otherwise(cls)


def circle_diameter(total: Column, largest: float, least_d: float, most_d: float) -> Column:
    return F.pow(F.least(total / largest, F.lit(1.0)), F.lit(0.25)) * (most_d - least_d) + least_d


def label_size(rank_value: Column) -> Column:
    return F.when(rank_value < 800, 13).otherwise(16)


def map_cells(df: DataFrame, parts: list[str], largest: float, least_d: float, most_d: float, centre, coefficient, box: tuple[int, int, int, int] | None = None) -> DataFrame:
    """Cells ready to draw: blanks count 0, total, diameter, class (``center`` where the total is 0); largest y first, then x."""
    cells = df.withColumns({p: F.coalesce(F.nullif(F.col(p).cast("string"), F.lit("")).try_cast("long"), F.lit(0)) for p in parts})
    if box:
        cells = cells.where(F.col("x").between(box[0], box[2]) & F.col("y").between(box[1], box[3]))
    total = sum((F.col(p) for p in parts[1:]), F.col(parts[0]))
    cls = F.coalesce(trivariate_class([F.col(p) for p in parts], centre, coefficient), F.lit("center"))
    return cells.withColumn("total", total).withColumn("diameter", circle_diameter(F.col("total"), largest, least_d, most_d)).withColumn("class", cls).orderBy(F.desc("y"), "x")
