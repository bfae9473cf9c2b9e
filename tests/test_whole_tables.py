"""Queries over whole tables, against plain Python over every row; small tables with parts that lie apart."""

import pytest

from gridloom.plans.catalogue import QUERIES
from gridloom.plans.datasets import edges, pois, pop_cells

NODES = 20
#: Two components of five nodes, one of three, one of two; degree one at 0, 4, 5, 6, 7 and 9.
LINKS = [(0, 1), (1, 2), (2, 3), (3, 4), (5, 6), (7, 8), (8, 9), (10, 11), (11, 12), (12, 13), (13, 14), (14, 10)]


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Tables whose edges are LINKS: the order's key is the one that leads to its end."""
    place = str(tmp_path_factory.mktemp("small"))
    rows = [(next(k for k in range(i * NODES, (i + 1) * NODES) if (k * 31 + 7) % NODES == b), a, 20000.0) for i, (a, b) in enumerate(LINKS)]
    spark.createDataFrame([(i,) for i in range(NODES)], "c_custkey long").write.parquet(f"{place}/customer.parquet")
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_totalprice double").write.parquet(f"{place}/orders.parquet")
    assert {(r.src, r.dst) for r in edges(spark, place).collect()} == set(LINKS)
    return place


def least_of_component(links):
    up = {}

    def top(n):
        while up.setdefault(n, n) != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in up}


def test_components_of_all_edges(spark, small):
    found = {r.node: r.component for r in QUERIES["graph_components"](spark, small).collect()}
    assert found == least_of_component(LINKS)


def test_pruned_edges_of_all_edges(spark, small):
    found = {(r.src, r.dst) for r in QUERIES["small_component_prune"](spark, small).collect()}
    assert found == {(a, b) for a, b in LINKS if a < 5 or a >= 10}


def test_degree_one_of_all_edges(spark, small):
    found = {(r.node, r.degree) for r in QUERIES["graph_degree_one"](spark, small).collect()}
    assert found == {(n, 1) for n in (0, 4, 5, 6, 7, 9)}


def test_pairs_of_all_cells(spark, tmp_path):
    spark.range(0, 130).selectExpr("id as c_custkey", "cast(id % 25 as int) as c_nationkey", "double(id) as c_acctbal").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(0, 12).selectExpr("id as s_suppkey", "cast(id % 25 as int) as s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    near = {(a.id, b.id) for a in pop_cells(spark, str(tmp_path)).collect() for b in pois(spark, str(tmp_path)).collect() if (a.x + 500 - b.x) ** 2 + (a.y + 500 - b.y) ** 2 <= 5000**2}
    assert len({a % 25 for a, _ in near}) > 1
    assert {(r.a, r.b) for r in QUERIES["pairs_within_distance"](spark, str(tmp_path)).collect()} == near


def test_targets_among_all_nodes(spark, tmp_path):
    nodes = 1701
    key = next(k for k in range(nodes) if (k * 31 + 7) % nodes == (900 * 13 + 5) % nodes)
    spark.range(0, nodes).selectExpr("id as c_custkey").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(key, 900, 20000.0)], "o_orderkey long, o_custkey long, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    found = {(r.a, r.b, r.cost) for r in QUERIES["pair_costs"](spark, str(tmp_path)).collect()}
    assert found == {(a, (a * 13 + 5) % nodes, 3 if a == 900 else None) for a in range(0, nodes, 300)}
