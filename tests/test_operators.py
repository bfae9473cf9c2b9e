import heapq
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gridloom.operators import demography, focal, grid, network, paths, raster, spatial
from gridloom.operators.components import connected_components


def brute_k_nearest(edges, sources, k):
    out = defaultdict(list)
    cheapest = {}
    for a, b, w in edges:
        cheapest[a, b] = min(w, cheapest.get((a, b), w))
    follow = defaultdict(list)
    for (a, b), w in cheapest.items():
        follow[a].append((b, w))
    for s in set(sources):
        cost, heap = {s: 0}, [(0, s)]
        while heap:
            c, n = heapq.heappop(heap)
            if c > cost[n]:
                continue
            for m, w in follow[n]:
                if c + w < cost.get(m, 1e18):
                    cost[m] = c + w
                    heapq.heappush(heap, (c + w, m))
        for n, c in cost.items():
            out[n].append((c, s))
    return {(n, s, c, r) for n, found in out.items() for r, (c, s) in enumerate(sorted(found)[:k], 1)}


def test_k_nearest_of_a_path(spark):
    edges = spark.createDataFrame([(1, 2, 5), (2, 1, 5), (2, 3, 5), (3, 2, 5)], "src long, dst long, w long")
    sources = spark.createDataFrame([(1,), (1,), (3,)], "node long")
    found = {tuple(r) for r in paths.k_nearest(edges, sources, 2).collect()}
    assert found == {(1, 1, 0, 1), (1, 3, 10, 2), (2, 1, 5, 1), (2, 3, 5, 2), (3, 3, 0, 1), (3, 1, 10, 2)}


@pytest.mark.parametrize("tile", [None, "node div 10"])
def test_costs_over_many_tiles(spark, monkeypatch, tile):
    rng = random.Random(11)
    edges = [(a, b, rng.randint(0, 9)) for a in range(60) for b in rng.sample(range(60), 3) if a != b]
    frame = spark.createDataFrame(edges, "src long, dst long, w long")
    origins = spark.createDataFrame([(s,) for s in (3, 17, 40)], "node long")
    monkeypatch.setattr(paths, "ARCS", 30)
    found = {tuple(r) for r in paths.k_nearest(frame, origins, 2, tile=tile).collect()}
    assert found == brute_k_nearest(edges, [3, 17, 40], 2)
    within = {(r.node, r.source, r.cost) for r in paths.reach(frame, origins, 12, tile=tile).collect()}
    assert within == {(n, s, c) for s in (3, 17, 40) for n, _, c, _ in brute_k_nearest(edges, [s], 1) if c <= 12}


def test_paths_over_arcs_without_cost(spark):
    edges = spark.createDataFrame([(1, 2, 0), (2, 3, 1), (3, 2, 0), (2, 1, 0), (3, 4, 0), (4, 5, 2), (1, 5, 9)], "src long, dst long, w long")
    assert [tuple(r) for r in paths.path_nodes(edges, 1, 3).orderBy("position").collect()] == [(0, 1, 0), (1, 2, 0), (2, 3, 1)]
    assert [r.node for r in paths.path_nodes(edges, 1, 5).orderBy("position").collect()] == [1, 2, 3, 4, 5]
    assert [tuple(r) for r in paths.path_nodes(edges, 4, 4).collect()] == [(0, 4, 0)]


def test_every_person_is_placed_once(spark):
    rng = random.Random(3)
    boxes = [(1, 300, x, y, x + rng.random() + 0.1, y + rng.random() + 0.1) for x in range(7) for y in range(9)]
    areas = spark.createDataFrame([tuple(map(float, b[2:])) + b[:2] for b in boxes], "xmin double, ymin double, xmax double, ymax double, unit long, total long")
    people = spark.range(1, 301).selectExpr("1L as unit", "id as person")
    placed = demography.place_people(people, areas, "unit", "total", seed=5)
    assert sorted(r.person for r in placed.collect()) == list(range(1, 301))


def test_targets_are_the_union_of_candidates(spark):
    rng = random.Random(6)
    homes = [(x, y, x + rng.randint(1, 9), y + rng.randint(1, 9)) for x, y in [(rng.randrange(30), rng.randrange(20)) for _ in range(25)]]
    units = spark.createDataFrame([(1, 0.0, 0.0, 20.0, 20.0), (2, 20.0, 0.0, 40.0, 20.0), (3, 90.0, 90.0, 95.0, 95.0)], "unit long, xmin double, ymin double, xmax double, ymax double")
    found = demography.dasymetric_targets(units, spark.createDataFrame([tuple(map(float, h)) for h in homes], "xmin double, ymin double, xmax double, ymax double"), 15.0).collect()
    for unit, lo, hi in ((1, 0, 20), (2, 20, 40)):
        cells = sorted((x, y) for x in range(lo, hi) for y in range(20) if any(a <= x < c and b <= y < d for a, b, c, d in homes))
        made = sorted((x, y) for r in found if r.unit == unit for x in range(int(r.xmin), int(r.xmax)) for y in range(int(r.ymin), int(r.ymax)))
        assert made == cells
    assert [(r.xmin, r.xmax) for r in found if r.unit == 3] == [(90.0, 95.0)]


def test_k_nearest_equals_dijkstra(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(60), rng.randrange(60), rng.randint(1, 9)) for _ in range(220)]
    sources = [3, 17, 17, 40, 99]
    frame = spark.createDataFrame(edges, "src long, dst long, w long")
    found = {tuple(r) for r in paths.k_nearest(frame, spark.createDataFrame([(s,) for s in sources], "node long"), 3).collect()}
    assert found == brute_k_nearest(edges, sources, 3)
    within = {tuple(r) for r in paths.reach(frame, spark.createDataFrame([(3,)], "node long"), 12).select("node", "source", "cost").collect()}
    assert within == {(n, s, c) for n, s, c, _ in brute_k_nearest(edges, [3], 1) if c <= 12}


def test_cheapest_path(spark):
    edges = spark.createDataFrame([(1, 2, 1), (2, 3, 1), (1, 3, 5), (3, 4, 1), (9, 1, 1)], "src long, dst long, w long")
    path = [tuple(r) for r in paths.path_nodes(edges, 1, 4).orderBy("position").collect()]
    assert path == [(0, 1, 0), (1, 2, 1), (2, 3, 2), (3, 4, 3)]
    assert paths.path_nodes(edges, 4, 1).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(110)] + [(i, i + 1) for i in range(300, 340)] + [(500, 500)]
    up = {n: n for e in edges for n in e}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    found = {tuple(r) for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert found == {(n, find(n)) for n in up}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_graph_of_sections(spark):
    rows = [(1, [[0.0, 0.0], [0.0, 100.0], [0.0, 300.0]], 30.0, 60.0), (2, [[0.0, 300.0], [50.0, 300.0]], None, 5.0)]
    sections = spark.createDataFrame(rows, "id long, line array<array<double>>, f double, b double")
    costs = F.struct(F.col("f").alias("forward"), F.col("b").alias("backward"))
    edges, nodes = network.build_graph(sections, costs=costs)
    assert {tuple(r) for r in edges.select("src", "dst", "w").collect()} == {("0_0", "0_300", 30.0), ("0_300", "0_0", 60.0), ("50_300", "0_300", 5.0)}
    assert {r["node"] for r in nodes.collect()} == {"0_0", "0_300", "50_300"}
    edges, _ = network.build_graph(sections, costs=costs, detailed=True)
    assert {tuple(r) for r in edges.where("section = 1").select("src", "dst", "w").collect()} == {("0_0", "0_100", 10.0), ("0_100", "0_300", 20.0), ("0_100", "0_0", 20.0), ("0_300", "0_100", 40.0)}
    edges, _ = network.build_graph(sections, costs=costs, detailed=True, end_blocked=F.col("id") == 1, level_from=F.lit(1), level_to=F.lit(2))
    assert {tuple(r) for r in edges.where("section = 1").select("src", "dst").collect()} == {("0_0_1", "0_100_1_2"), ("0_100_1_2", "0_0_1")}
    edges, _ = network.build_graph(sections.where("id = 1"), costs=costs, step=100.0)
    assert sorted(r["w"] for r in edges.where("src < dst").collect()) == pytest.approx([10.0, 10.0, 10.0])


def test_degrees_and_pruning(spark):
    edges = spark.createDataFrame([(1, 2, 1), (2, 1, 1), (2, 3, 1), (8, 9, 1)], "src long, dst long, w long")
    assert {tuple(r) for r in network.degrees(edges).collect()} == {(1, 1), (2, 2), (3, 1), (8, 1), (9, 1)}
    assert network.prune_small_components(edges, 3).count() == 3
    assert {r["node"] for r in network.largest_component(edges).collect()} == {1, 2, 3}


def test_focal_sums(spark):
    rng = random.Random(2)
    cells = {(rng.randrange(-20, 20), rng.randrange(-20, 20)): (rng.randint(-2, 9), rng.randrange(2)) for _ in range(300)}
    rows = [(x * 1000, y * 1000, v, k) for (x, y), (v, k) in cells.items()]
    frame = spark.createDataFrame(rows, "x long, y long, value long, code long")

    def brute(r, same):
        return {(x * 1000, y * 1000, k): sum(max(v2, 0) for (x2, y2), (v2, k2) in cells.items() if (x - x2) ** 2 + (y - y2) ** 2 <= r * r and (not same or k == k2)) for (x, y), (_, k) in cells.items()}

    for r in (1, 4):
        small = {(a["x"], a["y"]): a["focal"] for a in focal.focal_sum_small(frame, 1000, r * 1000).collect()}
        tiled = {(a["x"], a["y"]): a["focal"] for a in focal.focal_sum(frame, 1000, r * 1000, tile=8).collect()}
        expected = {(x, y): v for (x, y, _), v in brute(r, False).items()}
        assert small == expected and tiled == pytest.approx(expected)
        coded = {(a["x"], a["y"], a["code"]): a["focal"] for a in focal.focal_sum(frame, 1000, r * 1000, code="code", tile=8).collect()}
        assert coded == pytest.approx(brute(r, True))


def test_allocation(spark):
    children = spark.createDataFrame([(0, 0, 1.0), (0, 0, 2.0), (0, 0, 0.0), (5, 5, 1.0)], "x long, y long, area double")
    parents = spark.createDataFrame([(0, 0, 100.0)], "x long, y long, pop double")
    for made in (grid.allocate, grid.allocate_grouped):
        found = sorted(((r["x"], r["area"], r["allocated"]) for r in made(children, parents, ["x", "y"], "area", "pop").collect()))
        assert found == [(0, 0.0, 0.0), (0, 1.0, 33.33), (0, 2.0, 66.67), (5, 1.0, None)]


def test_tiles_of_negative_cells(spark):
    rows = spark.createDataFrame([(-1000, 500)], "x long, y long")
    row = grid.assign_tiles(rows, 500, 4).collect()[0]
    assert (row["tx"], row["ty"], row["col"], row["row"]) == (-1, 0, 2, 1)


def test_nearest_looks_beyond_its_buckets(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 99.0, 0.0)], "id long, x double, y double")
    targets = spark.createDataFrame([(7, 1000.0, 0.0), (8, 101.0, 0.0), (9, 97.0, 0.0)], "id long, x double, y double")
    found = {r["id"]: (r["target"], r["distance"]) for r in spatial.nearest(points, targets, 10.0).collect()}
    assert found == {1: (9, 97.0), 2: (8, 2.0)}
    assert spatial.nearest(points, targets, 10.0, limit=50).count() == 1
    assert spatial.nearest(points, targets.limit(0), 10.0).count() == 0


def test_codes_and_ties(spark):
    cells = spark.createDataFrame([(1, 0, 0), (2, 100000, 0)], "id long, x long, y long")
    regions = spark.createDataFrame([("B", 1500, 0, 3000, 1000), ("A", -900, 0, -500, 1000), ("C", 50000, 0, 51000, 10)], "code string, xmin long, ymin long, xmax long, ymax long")
    assert {tuple(r) for r in spatial.codes_within(cells, regions, 1000, 1500.0, 6000.0).collect()} == {(1, "A-B"), (2, "")}
    boxes = spark.createDataFrame([("a", 10, 0, 20, 1), ("b", -20, 0, -10, 1)], "box string, xmin long, ymin long, xmax long, ymax long")
    tied = {tuple(r) for r in spatial.nearest_boxes(spark.createDataFrame([(1, 0, 0), (2, 500, 500)], "id long, x long, y long"), boxes, 50.0, 50.0).collect()}
    assert tied == {(1, "a", 10.0), (1, "b", 10.0), (2, None, None)}


def test_building_straddling_two_cells(spark):
    rows = [(1, 25, 0, 125, 10, 2, 1.0, 0.0, 0.0)]
    frame = spark.createDataFrame(rows, "id long, xmin long, ymin long, xmax long, ymax long, floor_nb long, residential double, activity double, cultural_value double")
    found = {r["x"]: (r["number"], r["ground_area"], r["floor_area"], r["residential_floor_area"], r["cultural_ground_area"]) for r in demography.building_grid(frame, 100).collect()}
    assert found == {0: (0.75, 750.0, 1500.0, 1500.0, 0.0), 100: (0.25, 250.0, 500.0, 500.0, 0.0)}


def test_synthetic_people(spark):
    units = spark.createDataFrame([(1, 5, 3, 2, 1), (2, 0, 0, 0, 0), (3, 4, 4, 0, 4)], "unit long, total long, m long, f long, old long")
    people = demography.synthetic_people(units, "unit", "total", {"sex": ["m", "f"], "age": ["old"]}, seed=1)
    rows = people.collect()
    assert len(rows) == 9
    assert sum(r["age"] is None for r in rows if r["unit"] == 1) == 4
    stats = {r["unit"]: (r["total"], r["m"], r["f"], r["old"]) for r in demography.people_statistics(people, ["unit"], {"sex": ["m", "f"], "age": ["old"]}).collect()}
    assert stats == {1: (5, 3, 2, 1), 3: (4, 4, 0, 4)}
    boxes = spark.createDataFrame([(1, 5, 0.0, 0.0, 10.0, 10.0), (3, 4, 100.0, 0.0, 110.0, 10.0), (3, 4, 200.0, 0.0, 230.0, 10.0)], "unit long, total long, xmin double, ymin double, xmax double, ymax double")
    placed = demography.place_people(people, boxes, "unit", "total", threshold=4, seed=1).collect()
    assert len(placed) == 9
    assert all((r["px"], r["py"]) == (165.0, 5.0) for r in placed if r["unit"] == 3)
    assert all(0 <= r["px"] <= 10 and 0 <= r["py"] <= 10 for r in placed if r["unit"] == 1)


@pytest.mark.parametrize(("height", "expected"), [(7.0, 3), (None, 1), (301.0, 1), (-1.0, 1), (0.0, 1)])
def test_floors(spark, height, expected):
    assert spark.range(1).select(demography.floors(F.lit(height).cast("double"))).collect()[0][0] == expected


def test_flat_roofs_without_a_least_floor(spark):
    assert spark.range(1).select(demography.floors(F.lit(0.0), None, None, at_least_one=False)).collect()[0][0] == 0


def test_rasters(spark):
    a = spark.createDataFrame([(0, 0, 1.0), (1000, 0, 2.0)], "x long, y long, value double")
    b = spark.createDataFrame([(1000, 0, 5.0), (2000, 0, 6.0)], "x long, y long, value double")
    both = raster.combine_bands({"a": a, "b": b})
    assert sorted(map(tuple, both.collect())) == [(0, 0, 1.0, None), (1000, 0, 2.0, 5.0), (2000, 0, None, 6.0)]
    with pytest.raises(ValueError):
        raster.rename_bands(both, ["one"])
    box = spark.createDataFrame([(500, 0, 1400, 1000)], "xmin long, ymin long, xmax long, ymax long")
    assert sorted(r["x"] for r in raster.covered_by_boxes(both, box, 1000).collect()) == [0, 1000]
    assert [r["x"] for r in raster.covered_by_boxes(both, box, 1000, all_touched=False).collect()] == [0]
    with pytest.raises(ValueError):
        grid.resample(a, 1000, 1500)
    same = spark.createDataFrame([(0, 0, 1.0), (1000, 0, 1.0), (1000, 1000, 2.0), (5000, 0, 1.0)], "x long, y long, value double")
    found = {(r["x"], r["y"]): (r["patch"]["x"], r["patch"]["y"]) for r in raster.patches(same, 1000).collect()}
    assert found == {(0, 0): (0, 0), (1000, 0): (0, 0), (1000, 1000): (1000, 1000), (5000, 0): (5000, 0)}
