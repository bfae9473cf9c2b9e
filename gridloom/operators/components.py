"""Connected components of an undirected graph given as edges, by large-star and small-star rounds.

R. Kiveris et al., Connected Components in MapReduce and Beyond, 2014. Each round
hangs neighbours under the least node that a node can see; when nothing changes,
every component is a star around its least node. Rounds grow with the logarithm of
the component's size. Every round is written to the shared folder, so a lost
executor costs one round and plans stay short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.plans.shared import drop, keep


def _least_around(pairs: DataFrame) -> DataFrame:
    """pairs (u, v) with m, the least v of u: summed up on the map side first, so that a hub's neighbours never meet in one task."""
    return pairs.join(pairs.groupBy("u").agg(F.min("v").alias("m")), "u")


def _mark(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).collect()[0])


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of an edge; component is its least node. Loops give a node of its own; null ends are left out."""
    pairs = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")
    first = keep(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "components")
    stars, loops = first.where("u <> v"), first.where("u = v")
    mark = _mark(stars)
    for _ in range(max_rounds):
        # large star: the neighbours above a node hang under the least around it
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hung = _least_around(both).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = keep(hung, "large", mark[0])  # each pair once
        # small star: a node and its neighbours below it hang under the least of them
        below = _least_around(large)
        small = below.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("p")).select("p.u", "p.v")
        old, stars = stars, keep(small.where("u <> v").distinct(), "components", 2 * mark[0])
        drop(old, large)
        before, mark = mark, _mark(stars)
        if mark == before:
            break
    else:
        raise RuntimeError("components have not settled")
    named = [stars.select(F.col("u").alias("node"), F.col("v").alias("component")), *[df.select(F.col("v").alias("node"), F.col("v").alias("component")) for df in (stars, loops)]]
    return named[0].unionByName(named[1]).unionByName(named[2]).groupBy("node").agg(F.min("component").alias("component"))
