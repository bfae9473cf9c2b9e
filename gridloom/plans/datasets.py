"""The driver tables read as cells, points, boxes and edges: whole-number projections, the same in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pop_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1 km cells (id, x, y, pop, code) of customers."""
    return table(spark, sf_dir, "customer").selectExpr("c_custkey as id", "4000000 + ((c_custkey * 7919) % 60) * 1000 as x", "3000000 + ((c_custkey div 60) % 40) * 1000 as y", "cast(floor(abs(c_acctbal)) as bigint) as pop", "c_nationkey as code")


def pois(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points (id, x, y, code) of suppliers."""
    return table(spark, sf_dir, "supplier").selectExpr("s_suppkey as id", "4000000 + ((s_suppkey * 37 * 7919) % 60) * 1000 + 500 as x", "3000000 + (((s_suppkey * 37) div 60) % 40) * 1000 + 500 as y", "s_nationkey as code")


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directed edges (src, dst, w) between customers from orders; the cheapest of parallel ones."""
    n = table(spark, sf_dir, "customer").count()
    rows = table(spark, sf_dir, "orders").selectExpr("o_custkey as src", f"(o_orderkey * 31 + 7) % {n} as dst", "1 + cast(floor(o_totalprice / 10000) as bigint) as w")
    return rows.where("src <> dst").groupBy("src", "dst").agg(F.min("w").alias("w"))


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where("c_custkey % 300 = 0").selectExpr("c_custkey as node")


def buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes (id, xmin, ymin, xmax, ymax, floor_nb, residential, activity, cultural_value) of parts."""
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey as id", "4000000 + ((p_partkey * 7919) % 600) * 100 + (p_partkey % 7) * 10 as xmin", "3000000 + ((p_partkey div 600) % 400) * 100 + (p_partkey % 5) * 10 as ymin", "20 + p_size * 4 as side", "1 + cast(floor(p_retailprice / 300) as bigint) % 5 as floor_nb", "p_partkey % 3 as use")
    return rows.selectExpr("id", "xmin", "ymin", "xmin + side as xmax", "ymin + side as ymax", "floor_nb", "cast(use = 0 as int) as residential", "cast(use = 1 as int) as activity", "cast(use = 2 as int) as cultural_value")


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes (code, region, xmin, ymin, xmax, ymax) of nations that tile the cells' extent."""
    return table(spark, sf_dir, "nation").selectExpr("n_name as code", "n_regionkey as region", "cast(4000000 + (n_nationkey % 5) * 12000 as bigint) as xmin", "cast(3000000 + (n_nationkey div 5) * 8000 as bigint) as ymin", "cast(4012000 + (n_nationkey % 5) * 12000 as bigint) as xmax", "cast(3008000 + (n_nationkey div 5) * 8000 as bigint) as ymax")


def census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Census cells of customers with some wrong, missing and confidential values."""
    return table(spark, sf_dir, "customer").selectExpr(
        "concat('CRS3035RES1000mN', 3000000 + c_custkey * 1000, 'E4000000') as GRD_ID",
        "c_custkey % 40 as T",
        "c_custkey % 40 - (c_custkey % 40) div 2 as M",
        "case when c_custkey % 17 = 0 then null when c_custkey % 19 = 0 then -9999 else (c_custkey % 40) div 2 + cast(c_custkey % 23 = 0 as int) end as F",
        "case when c_custkey % 29 = 0 then -3 else c_custkey % 45 end as EMP",
        "cast(null as bigint) as T_CI",
        "case when c_custkey % 19 = 0 then -9999 when c_custkey % 31 = 0 then 7 end as F_CI",
        "case when c_custkey % 40 = 0 then cast(c_custkey % 80 = 0 as int) else 1 end as POPULATED",
    )


#: The same as SQL, by name; put together with ``sql``.
CTES = {
    "pop": "select c_custkey as id, 4000000 + ((c_custkey * 7919) % 60) * 1000 as x, 3000000 + ((c_custkey // 60) % 40) * 1000 as y, cast(floor(abs(c_acctbal)) as bigint) as pop, c_nationkey as code from customer",
    "poi": "select s_suppkey as id, 4000000 + ((s_suppkey * 37 * 7919) % 60) * 1000 + 500 as x, 3000000 + (((s_suppkey * 37) // 60) % 40) * 1000 + 500 as y, s_nationkey as code from supplier",
    "edges": "select src, dst, min(w) as w from (select o_custkey as src, (o_orderkey * 31 + 7) % (select count(*) from customer) as dst, 1 + cast(floor(o_totalprice / 10000) as bigint) as w from orders) where src <> dst group by 1, 2",
    "sources": "select c_custkey as node from customer where c_custkey % 300 = 0",
    "buildings": "select id, xmin, ymin, xmin + side as xmax, ymin + side as ymax, floor_nb, cast(use = 0 as int) as residential, cast(use = 1 as int) as activity, cast(use = 2 as int) as cultural_value from (select p_partkey as id, 4000000 + ((p_partkey * 7919) % 600) * 100 + (p_partkey % 7) * 10 as xmin, 3000000 + ((p_partkey // 600) % 400) * 100 + (p_partkey % 5) * 10 as ymin, 20 + p_size * 4 as side, 1 + cast(floor(p_retailprice / 300) as bigint) % 5 as floor_nb, p_partkey % 3 as use from part)",
    "zones": "select n_name as code, n_regionkey as region, cast(4000000 + (n_nationkey % 5) * 12000 as bigint) as xmin, cast(3000000 + (n_nationkey // 5) * 8000 as bigint) as ymin, cast(4012000 + (n_nationkey % 5) * 12000 as bigint) as xmax, cast(3008000 + (n_nationkey // 5) * 8000 as bigint) as ymax from nation",
    "census": "select 'CRS3035RES1000mN' || (3000000 + c_custkey * 1000) || 'E4000000' as GRD_ID, c_custkey % 40 as T, c_custkey % 40 - (c_custkey % 40) // 2 as M, case when c_custkey % 17 = 0 then null when c_custkey % 19 = 0 then -9999 else (c_custkey % 40) // 2 + cast(c_custkey % 23 = 0 as int) end as F, case when c_custkey % 29 = 0 then -3 else c_custkey % 45 end as EMP, cast(null as bigint) as T_CI, case when c_custkey % 19 = 0 then -9999 when c_custkey % 31 = 0 then 7 end as F_CI, case when c_custkey % 40 = 0 then cast(c_custkey % 80 = 0 as int) else 1 end as POPULATED from customer",
}


def sql(body: str, *names: str, recursive: bool = False) -> str:
    """SQL with the named relations in front."""
    held = ", ".join(f"{n} as ({CTES[n]})" for n in names)
    return (f"with {'recursive ' if recursive else ''}{held}{', ' if held and recursive else ' '}" if held else ("with recursive " if recursive else "")) + body
