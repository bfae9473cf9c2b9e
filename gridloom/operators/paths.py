"""Shortest travel costs, settled tile by tile.

Nodes are dealt to tiles of bounded size. A tile settles all it can reach in one go:
from its seeds (source nodes, and what came in over its border) it takes labels (cost,
source, node) in order of cost, and passes those of nodes with arcs into other tiles on
as seeds there. Only tiles with new seeds work in a round, so rounds follow the tiles
that a path crosses and not its hops; a graph of one tile takes one round. k-nearest
keeps only a node's k best sources, which is safe with costs that are not negative: a
source among the k best of a node is among the k best of the node before it on its path,
ties included. Rounds are written to the shared folder.

Tiles hold about ARCS arcs. ``tile`` names an expression over ``node`` (a place, say) that keeps neighbours together.

Without it nearly every arc of a larger graph would leave its tile, so that graph is not cut
into tiles: arcs are dealt by their start once and kept in memory or on disk, and in a round
only labels that got better, and lie within a mean arc's cost of the least of them, follow
their arcs (after U. Meyer, P. Sanders, Delta-stepping, 2003). Most labels follow theirs once.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from gridloom.plans.shared import drop, keep, tasks

ARCS = 500_000


def _coded(column: pa.ChunkedArray, values: pa.Array) -> list[int]:
    return pc.index_in(column, values).to_pylist()


def _settle(arcs: pa.Table, seeds: pa.Table, k: int | None, limit: float | None) -> tuple[list, list]:
    """(labels of the tile's nodes, labels that leave it), as (node, source, cost) each."""
    named = pa.chunked_array([*arcs.column("src").chunks, *arcs.column("dst").chunks, *seeds.column("node").chunks])
    nodes = pc.unique(named)
    sources = pc.unique(seeds.column("source"))
    sources = sources.take(pc.sort_indices(sources))
    src, dst = _coded(arcs.column("src"), nodes), _coded(arcs.column("dst"), nodes)
    outside = [False] * len(nodes)
    after: list[list] = [[] for _ in range(len(nodes))]
    for a, b, w, out in zip(src, dst, arcs.column("w").to_pylist(), arcs.column("out").to_pylist(), strict=True):
        after[a].append((w, b))
        if out:
            outside[b] = True
    held = list(zip(seeds.column("cost").to_pylist(), _coded(seeds.column("source"), sources), _coded(seeds.column("node"), nodes), strict=True))
    heapq.heapify(held)
    settled: list[dict] = [{} for _ in range(len(nodes))]
    while held:
        cost, source, node = heapq.heappop(held)
        here = settled[node]
        if source in here or (k is not None and len(here) >= k):
            continue
        here[source] = cost
        for w, b in after[node]:
            reached = cost + w
            if (limit is None or reached <= limit) and source not in settled[b] and (k is None or len(settled[b]) < k):
                heapq.heappush(held, (reached, source, b))
    inner, leaving = [], []
    names, origins = nodes.to_pylist(), sources.to_pylist()
    for node, here in enumerate(settled):
        into = leaving if outside[node] else inner
        into += [(names[node], origins[source], cost) for source, cost in here.items()]
    return inner, leaving


def _by_rounds(start: DataFrame, arcs: DataFrame, size: int, k: int | None, max_rounds: int, limit: float | None) -> DataFrame:
    """(node, source, cost): settled labels; in a round the better ones of the least costs follow their arcs."""
    n = min(tasks(arcs.sparkSession), -(-size // 250_000))
    kind = arcs.schema["w"].dataType
    widest, step = arcs.groupBy("src").agg(F.count("*").alias("n"), F.sum("w").alias("w")).agg(F.max("n"), F.sum(F.col("w").cast("double")) / size).first()
    # a row for each node's arcs is ten times as quick to pass over as one for each arc; those of a hub are parted
    part = F.pmod(F.xxhash64("dst"), F.lit(-(-widest // 1000)))
    arcs = arcs.repartition(n, "src").groupBy("src", part).agg(F.collect_list(F.struct("dst", "w")).alias("out")).select("src", "out").sortWithinPartitions("src").persist()
    best = Window.partitionBy("node").orderBy("cost", "source")
    labels = keep(start.select("node", "source", F.col("cost").cast(kind).alias("cost"), F.lit(True).alias("open")), "labels")
    try:
        for _ in range(max_rounds):
            least = labels.where("open").agg(F.min("cost")).first()[0]
            if least is None:
                return labels.select("node", "source", "cost")
            go = F.col("open") & (F.col("cost") <= least + step)
            front = labels.where(go).select("node", "source", "cost").repartition(n, "node")
            reached = front.hint("merge").join(arcs, front["node"] == arcs["src"]).select("source", "cost", F.inline("out"))
            reached = reached.select(F.col("dst").alias("node"), "source", (F.col("cost") + F.col("w")).cast(kind).alias("cost"), F.lit(True).alias("open"))
            reached = reached.where(F.col("cost") <= limit) if limit is not None else reached
            # of equal costs the label that followed its arcs already stays
            least_of = F.min(F.struct("cost", "open")).alias("l")
            more = labels.withColumn("open", F.col("open") & ~go).unionByName(reached).repartition(n, "node").groupBy("node", "source").agg(least_of).select("node", "source", "l.cost", "l.open")
            more = more if k is None else more.withColumn("__r", F.row_number().over(best)).where(F.col("__r") <= k).drop("__r")
            before, labels = labels, keep(more, "labels")
            drop(before)
    finally:
        arcs.unpersist()
    raise RuntimeError("costs have not settled")


def _relax(start: DataFrame, edges: DataFrame, k: int | None, max_rounds: int, limit: float | None, tile: str | None = None) -> DataFrame:
    """(node, source, cost): settled labels from the start's (node, source, cost)."""
    spark = edges.sparkSession
    arcs = keep(edges.where("w >= 0").groupBy("src", "dst").agg(F.min("w").alias("w")), "arcs")
    size = arcs.count()
    tiles = max(1, -(-size // ARCS))
    if tiles > 1 and tile is None:
        return _by_rounds(start, arcs, size, k, max_rounds, limit)
    # sources are independent of one another where all are kept: few tiles are also split by source
    ways = 1 if k is not None else max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")) // tiles, start.count()))
    at = lambda c: (F.expr(tile.replace("node", c)) if tile else F.pmod(F.xxhash64(c), F.lit(tiles))).cast("long")
    way = lambda c: F.pmod(F.xxhash64(F.lit(7), c), F.lit(ways)).cast("long")
    arcs = arcs.withColumns({"tile": at("src"), "out": at("src") != at("dst")})
    if ways > 1:
        arcs = arcs.withColumn("way", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(ways - 1).cast("long"))))
    else:
        arcs = arcs.withColumn("way", F.lit(0).cast("long"))
    node_type, cost_type = edges.schema["src"].dataType, edges.schema["w"].dataType
    out = T.StructType([T.StructField("tile", T.LongType()), T.StructField("way", T.LongType()), T.StructField("leaves", T.BooleanType()), T.StructField("node", node_type), T.StructField("source", start.schema["source"].dataType), T.StructField("cost", cost_type)])

    def settle(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(out)
        if not right.num_rows:
            return schema.empty_table()
        made = _settle(left, right, k, limit)
        rows = [*made[0], *made[1]]
        columns = [[key[0].as_py()] * len(rows), [key[1].as_py()] * len(rows), [False] * len(made[0]) + [True] * len(made[1]), *([r[i] for r in rows] for i in range(3))]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    best = Window.partitionBy("node", "way").orderBy("cost", "source")

    def few(df: DataFrame) -> DataFrame:
        least = df.groupBy("tile", "way", "node", "source").agg(F.min("cost").alias("cost"))
        return least if k is None else least.withColumn("__r", F.row_number().over(best)).where(F.col("__r") <= k).drop("__r")

    seeds = keep(few(start.withColumns({"tile": at("node"), "way": way("source")})), "seeds")
    active = keep(seeds.select("tile", "way").distinct(), "active")
    labels = kept = None
    for _ in range(max_rounds):
        todo = active
        some_arcs, some_seeds = arcs.join(F.broadcast(todo) if tiles * ways <= 100_000 else todo, ["tile", "way"], "left_semi"), seeds.join(todo, ["tile", "way"], "left_semi")
        fresh = keep(some_arcs.groupBy("tile", "way").cogroup(some_seeds.groupBy("tile", "way")).applyInArrow(settle, out), "settled")
        inner = fresh.where("not leaves").drop("leaves")
        labels = inner if labels is None else labels.join(todo, ["tile", "way"], "left_anti").unionByName(inner)
        if tiles == 1 and tile is None:
            return labels.select("node", "source", "cost")
        before, labels = kept, keep(labels, "labels")
        kept = labels
        leaving = fresh.where("leaves").select(at("node").alias("tile"), "way", "node", "source", "cost")
        more = keep(few(seeds.unionByName(leaving)), "seeds")
        new = more.join(seeds, ["tile", "way", "node", "source", "cost"], "left_anti")
        active = keep(new.select("tile", "way").distinct(), "active")
        drop(before, fresh, todo, seeds)
        seeds = more
        if not active.limit(1).count():
            return labels.select("node", "source", "cost")
    raise RuntimeError("costs have not settled")


def k_nearest(edges: DataFrame, sources: DataFrame, k: int, max_rounds: int = 10_000, tile: str | None = None) -> DataFrame:
    """(node, source, cost, rank): the k nearest distinct source nodes of each node, along edges (src, dst, w) away from the source.

    Equal costs are ranked by source. A source is its own nearest with cost 0. Unreached nodes have no rows.
    """
    window = Window.partitionBy("node").orderBy("cost", "source")
    zero = edges.schema["w"].dataType
    start = sources.select("node").distinct().select("node", F.col("node").alias("source"), F.lit(0).cast(zero).alias("cost"))
    return _relax(start, edges, k, max_rounds, None, tile).withColumn("rank", F.row_number().over(window))


def nearest_source(edges: DataFrame, sources: DataFrame) -> DataFrame:
    return k_nearest(edges, sources, 1).drop("rank")


def reach(edges: DataFrame, origins: DataFrame, limit: float, max_rounds: int = 10_000, tile: str | None = None) -> DataFrame:
    """(source, node, cost) of every node within the cost limit (included) of each origin."""
    zero = edges.schema["w"].dataType
    start = origins.select("node").distinct().select("node", F.col("node").alias("source"), F.lit(0).cast(zero).alias("cost"))
    return _relax(start, edges, None, max_rounds, limit, tile)


def reachable_sum(edges: DataFrame, origins: DataFrame, amounts: DataFrame, limit: float, name: str = "reachable") -> DataFrame:
    """(source, name): sum of the amounts (node, amount) at the nodes within reach of each origin."""
    totals = amounts.groupBy("node").agg(F.sum("amount").alias("amount"))
    return reach(edges, origins, limit).join(totals.hint("merge"), "node", "left").groupBy("source").agg(F.coalesce(F.sum("amount"), F.lit(0)).alias(name))


def path_nodes(edges: DataFrame, source, target) -> DataFrame:
    """(position, node, cost) along a cheapest path; of equally cheap ones one with fewest steps, then of least named nodes. Empty without a path."""
    spark = edges.sparkSession
    kind = edges.schema["src"].dataType
    one = spark.range(1).select(F.lit(source).cast(kind).alias("node"))
    cost = keep(nearest_source(edges, one).select("node", "cost"), "costs")
    arcs = edges.where("w >= 0").groupBy("src", "dst").agg(F.min("w").alias("w"))
    tight = arcs.join(cost.withColumnsRenamed({"node": "src", "cost": "c0"}), "src").join(cost.withColumnsRenamed({"node": "dst", "cost": "c1"}), "dst").where(F.abs(F.col("c0") + F.col("w") - F.col("c1")) <= 1e-9 * F.greatest(F.col("c1"), F.lit(1)))
    tight = keep(tight.select("src", "dst", F.lit(1).cast("long").alias("w")), "tight")
    steps = keep(nearest_source(tight, one).select("node", F.col("cost").alias("n")), "steps")  # arcs without a cost are steps too
    back = tight.join(steps.withColumnsRenamed({"node": "src", "n": "n0"}), "src").join(steps.withColumnsRenamed({"node": "dst", "n": "n1"}), "dst").where("n0 + 1 = n1")
    jump = keep(back.groupBy("dst").agg(F.min("src").alias("src")), "back")  # a node and the one 1, 2, 4, ... steps before it
    path = keep(steps.where(F.col("node") == F.lit(target)).select("node"), "path")
    longest = path.join(steps, "node").agg(F.max("n")).first()[0] or 0
    for _ in range(int(longest).bit_length()):
        path = keep(path.unionByName(path.join(jump, path["node"] == jump["dst"]).select(F.col("src").alias("node"))), "path")
        jump = keep(jump.select("dst", F.col("src").alias("via")).join(jump.select(F.col("dst").alias("via"), "src"), "via").select("dst", "src"), "back")
    return path.join(steps, "node").join(cost, "node").select(F.col("n").cast("int").alias("position"), "node", "cost")


def access_grid(cells: DataFrame, labels: DataFrame, k: int, res: int, speed: float | None = None, limit: float | None = None) -> DataFrame:
    """Cells with the costs of their snapped node: duration_1..k and their average, -1 where fewer than k are known.

    cells: grd_id, node, distance (to the node, cut off at ``limit``); access at ``speed`` metres a second is added.
    """
    held = cells.where(F.col("distance") < limit) if limit else cells
    added = F.col("distance") / speed if speed else F.lit(0.0)
    wide = labels.groupBy("node").agg(*[F.max(F.when(F.col("rank") == i, F.col("cost"))).alias(f"c{i}") for i in range(1, k + 1)])
    costs = {f"duration_{i}": F.coalesce(F.col(f"c{i}") + added, F.lit(-1.0)) for i in range(1, k + 1)}
    known = sum((F.col(f"c{i}") for i in range(2, k + 1)), F.col("c1"))
    return held.join(wide.hint("merge"), "node", "left").select("grd_id", F.bround("distance").cast("long").alias("distance_to_node"), *[c.alias(n) for n, c in costs.items()], F.coalesce(known / k + added, F.lit(-1.0)).alias("duration_average"))


def pair_costs(edges: DataFrame, pairs: DataFrame, limit: float | None = None) -> DataFrame:
    """(a, b, cost) of node pairs (a, b): the cheapest way from a to b; null without one (or none within the limit)."""
    origins = pairs.select(F.col("a").alias("node")).distinct()
    found = reach(edges, origins, limit if limit is not None else float("inf")).select(F.col("source").alias("a"), F.col("node").alias("b"), "cost")
    return pairs.join(found.hint("merge"), ["a", "b"], "left")  # a kept table is small on disk, not in a driver that broadcasts it
