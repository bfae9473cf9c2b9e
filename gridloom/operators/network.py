"""Road networks: sections to nodes and directed edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.geometry import densify, ends, line_length, segments
from gridloom.operators.components import connected_components


def build_graph(sections: DataFrame, *, costs: Column, snappable: Column | None = None, detailed: bool = False, step: float | None = None, line: str = "line", start_blocked: Column | None = None, end_blocked: Column | None = None, level_from: Column | None = None, level_to: Column | None = None, whole_length_each: bool = False) -> tuple[DataFrame, DataFrame]:
    """(edges: src, dst, w, section; nodes: node, x, y, snappable) of sections (id, line).

    costs: struct(forward, backward) for a metre-long section's whole length is expected under the section's own
    length; it is shared out by segment length. A null or negative cost closes a direction, its nodes stay.
    Without ``detailed`` only a section's ends count. ``step`` adds points so no segment is longer.
    Blocked ends lose their last segment. Levels part nodes that meet in place but not in height: they are
    appended to the node's name, also on inner nodes, so that sections meet only at their ends.
    whole_length_each: charge each piece the whole section (a known way of reading undetailed sections).
    """
    flag = lambda c: F.coalesce(c, F.lit(False)) if c is not None else F.lit(False)
    text = lambda c: F.coalesce(c.cast("string"), F.lit("")) if c is not None else F.lit("")
    points = F.col(line) if detailed else ends(F.col(line))
    points = densify(points, step) if step else points
    held = sections.select("id", F.col(line).alias("l"), points.alias("p"), costs.alias("c"), (snappable if snappable is not None else F.lit(True)).alias("ok"), flag(start_blocked).alias("sb"), flag(end_blocked).alias("eb"), text(level_from).alias("lf"), text(level_to).alias("lt")).where(F.size("p") >= 2)
    name = lambda p: F.concat_ws("_", F.bround(p[0]).cast("long").cast("string"), F.bround(p[1]).cast("long").cast("string"))
    rows = held.select("*", line_length(F.col("p")).alias("whole"), F.posexplode(segments(F.col("p"))).alias("i", "s"))
    last = F.size("p") - 2
    rows = rows.where(~(F.col("sb") & (F.col("i") == 0)) & ~(F.col("eb") & (F.col("i") == last)))
    level = level_from is not None
    both = F.concat(F.lit("_"), F.col("lf"), F.lit("_"), F.col("lt"))
    first_level = F.when(F.col("i") == 0, F.concat(F.lit("_"), F.col("lf"))).when(F.col("sb") & (F.col("i") == 1), F.lit("")).otherwise(both)
    last_level = F.when(F.col("i") == last, F.concat(F.lit("_"), F.col("lt"))).otherwise(both)
    a = F.concat(name(F.col("s")[0]), first_level) if level else name(F.col("s")[0])
    b = F.concat(name(F.col("s")[1]), last_level) if level else name(F.col("s")[1])
    share = F.lit(1.0) if whole_length_each else F.when(F.col("whole") > 0, line_length(F.col("s")) / F.col("whole")).otherwise(F.lit(0.0))
    rows = rows.select("id", a.alias("a"), b.alias("b"), share.alias("share"), "c", "ok", F.col("s")[0].alias("pa"), F.col("s")[1].alias("pb")).where("a <> b")
    along = rows.select(F.col("a").alias("src"), F.col("b").alias("dst"), (F.col("c.forward") * F.col("share")).alias("w"), F.col("id").alias("section"))
    back = rows.select(F.col("b").alias("src"), F.col("a").alias("dst"), (F.col("c.backward") * F.col("share")).alias("w"), F.col("id").alias("section"))
    edges = along.unionByName(back).where(F.col("w") >= 0)
    near = lambda p: (F.bround(p[0]).cast("long"), F.bround(p[1]).cast("long"))
    sides = [rows.select(F.col(n).alias("node"), near(F.col(p))[0].alias("x"), near(F.col(p))[1].alias("y"), "ok") for n, p in (("a", "pa"), ("b", "pb"))]
    nodes = sides[0].unionByName(sides[1]).groupBy("node").agg(F.first("x").alias("x"), F.first("y").alias("y"), F.max("ok").alias("snappable"))
    return edges, nodes


def undirected(edges: DataFrame, order: str | None = None) -> DataFrame:
    """One edge (a < b) for each pair of neighbours; of parallel edges the last by ``order``, else the cheapest."""
    pairs = edges.where("w >= 0 and src <> dst").withColumns({"a": F.least("src", "dst"), "b": F.greatest("src", "dst")})
    return pairs.groupBy("a", "b").agg((F.max_by("w", order) if order else F.min("w")).alias("w"))


def with_both_directions(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("src"), F.col("b").alias("dst"), "w").unionByName(edges.select(F.col("b").alias("src"), F.col("a").alias("dst"), "w"))


def degrees(edges: DataFrame) -> DataFrame:
    """(node, degree): distinct neighbours other than itself."""
    pairs = edges.where("src <> dst").select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct()
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))


def component_sizes(edges: DataFrame) -> DataFrame:
    return connected_components(edges).groupBy("component").agg(F.count("*").alias("size"))


def prune_small_components(edges: DataFrame, least: int = 50) -> DataFrame:
    """Edges of the components with at least so many nodes."""
    label = connected_components(edges)
    small = label.join(label.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") < least), "component").select(F.col("node").alias("src"))
    return edges.join(small, "src", "left_anti")


def largest_component(edges: DataFrame) -> DataFrame:
    """Nodes of the largest component; the least named of equal ones."""
    label = connected_components(edges)
    best = label.groupBy("component").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "component").limit(1).select("component")
    return label.join(F.broadcast(best), "component").select("node")
