"""Joins whose sides or results are far larger than Spark's estimates, against plain Python; their plans."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gridloom.functions import geometry as G
from gridloom.operators import paths, spatial, tessellation
from gridloom.plans.catalogue import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """Parts whose buildings overlap; the table is small enough for Spark to broadcast."""
    place = str(tmp_path_factory.mktemp("parts"))
    spark.range(0, 3000).selectExpr("id as p_partkey", "cast(1 + id * 7 % 50 as int) as p_size", "double(900 + id) as p_retailprice").write.parquet(f"{place}/part.parquet")
    return place


def test_tessellation_broadcasts_nothing(spark, parts):
    assert "Broadcast" not in plan(QUERIES["tessellation_issues"](spark, parts))


def test_overlaps_and_noding_equal_every_pair(spark):
    rng = random.Random(5)
    boxes = [(i, x, y, x + rng.randint(3, 90), y + rng.randint(3, 90)) for i in range(60) for x, y in [(rng.randint(-200, 200), rng.randint(-200, 200))]]
    frame = spark.createDataFrame(boxes, "id long, xmin long, ymin long, xmax long, ymax long")
    polygons = frame.select("id", F.array(G.box_ring(F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax"))).alias("rings"))
    shared = set()
    for a in boxes:
        for b in boxes[: a[0]]:
            x1, y1, x2, y2 = max(a[1], b[1]), max(a[2], b[2]), min(a[3], b[3]), min(a[4], b[4])
            if x1 < x2 and y1 < y2:
                shared.add((f"area={(x2 - x1) * (y2 - y1)}", "intersection", (x1 + x2) / 2, (y1 + y2) / 2))
    assert shared and {tuple(r) for r in tessellation.overlaps(frame, 50.0).collect()} == shared
    rings = [[(a, b), (c, b), (c, d), (a, d), (a, b)] for _, a, b, c, d in boxes]
    near = set()
    for px, py in {p for r in rings for p in r}:
        for r in rings:
            for (ax, ay), (bx, by) in zip(r, r[1:], strict=False):
                d = math.hypot(px - min(max(px, min(ax, bx)), max(ax, bx)), py - min(max(py, min(ay, by)), max(ay, by)))
                if 0 < d <= 5:
                    near.add((px, py, round(d, 9)))
    found = [(r.x, r.y, round(float(r.description.removeprefix("distance=")), 9)) for r in tessellation.noding(polygons, 250.0, 5.0).collect()]
    found = [f for f in found if f[2]]  # segment_distance gives some touching vertices 1e-14
    assert near and set(found) == near and len(found) == len(near)


def test_area_in_cells_equals_clipping(spark):
    rng = random.Random(9)
    at = lambda: (4000000 + rng.uniform(0, 400), 3000000 + rng.uniform(0, 400))
    rings = [[at() for _ in range(rng.randint(3, 8))] for _ in range(60)]
    # a hook whose box has cells without a part of it, and a ring that runs back over itself
    rings += [[(0.0, 0.0), (300.0, 0.0), (300.0, 300.0), (290.0, 300.0), (290.0, 10.0), (0.0, 10.0)], [(0.0, 0.0), (250.0, 0.0), (250.0, 50.0), (250.0, 0.0)]]
    frame = spark.createDataFrame([(i, [list(map(float, p)) for p in [*r, r[0]]]) for i, r in enumerate(rings)], "id long, ring array<array<double>>")
    made = {(r.id, r.cx, r.cy): r.area for r in G.overlay_polygons(frame, 100).collect()}
    moved = frame.select("id", F.transform("ring", lambda p: F.array(p[0] - F.when(F.col("id") < 60, 4000000).otherwise(0), p[1] - F.when(F.col("id") < 60, 3000000).otherwise(0))).alias("ring"))
    cells = moved.crossJoin(spark.range(5).selectExpr("id * 100 as cx")).crossJoin(spark.range(5).selectExpr("id * 100 as cy"))
    clipped = cells.withColumn("area", F.abs(G.ring_area(G.clip_ring(F.col("ring"), F.col("cx"), F.col("cy"), F.col("cx") + 100, F.col("cy") + 100)))).where("area > 1e-7")
    held = {(r.id, r.cx + (4000000 if r.id < 60 else 0), r.cy + (3000000 if r.id < 60 else 0)): r.area for r in clipped.collect()}
    assert {k for k, v in made.items() if v > 1e-6} == {k for k, v in held.items() if v > 1e-6}
    assert all(abs(made[k] - v) < 1e-5 for k, v in held.items() if v > 1e-6)
    assert {k[1:] for k in made if k[0] == 60} == {(0, 0), (100, 0), (200, 0), (200, 100), (200, 200)}
    assert not [k for k in made if k[0] == 61]


def test_polygons_of_one_file_are_dealt(spark, parts):
    made = QUERIES["polygon_cell_overlay"](spark, parts)
    assert made.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism


def test_pairs_of_crowded_places(spark, monkeypatch):
    monkeypatch.setattr(spatial, "IDS", 4)
    rng = random.Random(2)
    a, b = ([(i, rng.randrange(6) * 10.0, rng.randrange(3) * 10.0) for i in range(n)] for n in (150, 40))
    a += [(900, None, 0.0), (901, -0.0, 5.0), (902, -40.0, 0.0)]
    frames = [spark.createDataFrame(r, "id long, x double, y double") for r in (a, b)]
    held = sorted((i, j, math.hypot(x - u, y - v)) for i, x, y in a if x is not None for j, u, v in b if math.hypot(x - u, y - v) <= 20)
    made = spatial.pairs_within(*frames, 20.0)
    assert [(r.a, r.b) for r in made.orderBy("a", "b").collect()] == [h[:2] for h in held]
    assert all(abs(r.distance - h[2]) < 1e-9 for r, h in zip(made.orderBy("a", "b").collect(), held, strict=True))
    # few rows make many: the tasks don't go by the size of the sides
    assert made.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
    assert "Broadcast" not in plan(made)


@pytest.fixture(scope="module")
def network(spark, tmp_path_factory):
    """Customers and orders: a graph of 900 nodes."""
    place = str(tmp_path_factory.mktemp("network"))
    spark.range(0, 900).selectExpr("id as c_custkey", "double(id) as c_acctbal", "cast(id % 25 as int) as c_nationkey").write.parquet(f"{place}/customer.parquet")
    spark.range(0, 4000).selectExpr("id as o_orderkey", "id * 7 % 900 as o_custkey", "double(id * 7919 % 500000) as o_totalprice").write.parquet(f"{place}/orders.parquet")
    return place


def test_larger_graph_is_not_cut_by_hash(spark, monkeypatch):
    kept, held = [], paths.keep
    monkeypatch.setattr(paths, "keep", lambda df, name, *a, **k: kept.append(name) or held(df, name, *a, **k))
    monkeypatch.setattr(paths, "ARCS", 1)
    edges = spark.createDataFrame([(1, 2, 5), (2, 3, 5), (1, 3, 12)], "src long, dst long, w long")
    found = {tuple(r) for r in paths.k_nearest(edges, spark.createDataFrame([(1,)], "node long"), 2).collect()}
    assert found == {(1, 1, 0, 1), (2, 1, 5, 1), (3, 1, 10, 1)}
    assert set(kept) == {"arcs", "labels"}


def test_arcs_of_a_hub_are_parted(spark, monkeypatch):
    monkeypatch.setattr(paths, "ARCS", 500)
    edges = spark.range(1, 2501).selectExpr("0L as src", "id as dst", "id % 7 as w").union(spark.range(1, 2501).selectExpr("id as src", "id + 5000 as dst", "1L as w"))
    found = {(r.node, r.cost) for r in paths.reach(edges, spark.createDataFrame([(0,)], "node long"), 6).collect()}
    assert found == {(0, 0)} | {(i, i % 7) for i in range(1, 2501)} | {(i + 5000, i % 7 + 1) for i in range(1, 2501) if i % 7 < 6}


@pytest.mark.parametrize("name", ["accessibility_grid", "pair_costs"])
def test_labels_are_not_broadcast(spark, network, name):
    assert "Broadcast" not in plan(QUERIES[name](spark, network))
