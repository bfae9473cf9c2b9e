"""Every registered query of the grid, raster, network and demography operators, with its SQL where it has one."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import cells as C
from gridloom.functions import census as S
from gridloom.functions import classify as K
from gridloom.functions import geometry as G
from gridloom.functions import projection as P
from gridloom.functions import roads as R
from gridloom.functions import tags as T
from gridloom.operators import demography as D
from gridloom.operators import focal, grid, network, paths, raster, spatial, tessellation
from gridloom.operators.components import connected_components
from gridloom.plans import datasets as X
from gridloom.plans.datasets import sql, table
from gridloom.plans.shared import keep, tasks
from gridloom.sources import readers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLE[fn.__name__] = oracle
        return fn

    return register


c = F.col
CELL = "'CRS3035RES1000mN' || y || 'E' || x"

# cells and ids


@query(sql(f"select id, {CELL} as grd_id, 3035::bigint as crs, 1000::bigint as res, x, y from pop", "pop"))
def cell_codec_roundtrip(spark, sf):
    made = X.pop_cells(spark, sf).select("id", C.cell_id(c("x"), c("y"), 1000).alias("grd_id"))
    return made.select("id", "grd_id", *[C.cell_part(c("grd_id"), p).alias(p) for p in ("crs", "res", "x", "y")])


@query("select c_custkey as id, 'CRS9947RES1000mN' || (c_custkey % 900 + 100) || '000E' || (c_custkey % 800 + 100) || '000' as grd_id from customer")
def iceland_id(spark, sf):
    local = table(spark, sf, "customer").selectExpr("c_custkey as id", "concat('1kmN', c_custkey % 900 + 100, 'E', c_custkey % 800 + 100) as local_id")
    return local.select("id", C.iceland_cell_id(c("local_id")).alias("grd_id"))


@query("select c_custkey as id, (1000 + c_custkey % 9000) * 1000 as x, (9999 - c_custkey % 9000) * 1000 as y from customer")
def survey_point_id(spark, sf):
    x, y = C.survey_point_xy(c("point"))
    return table(spark, sf, "customer").selectExpr("c_custkey as id", "concat(1000 + c_custkey % 9000, 9999 - c_custkey % 9000) as point").select("id", x.alias("x"), y.alias("y"))


@query("select c_custkey as id, substr(c_name, 4) as cell, left(c_name, 2) as country, 'cu' as of_file from customer")
def country_prefix(spark, sf):
    name = F.lit("/data/census_grid_2/ESTAT_OBS-VALU_cu_2021.csv")
    return table(spark, sf, "customer").select(c("c_custkey").alias("id"), C.without_country(c("c_name")).alias("cell"), F.substring("c_name", 1, 2).alias("country"), F.lower(F.substring(F.replace(F.element_at(F.split(name, "/"), -1), F.lit("ESTAT_OBS-VALU"), F.lit("ESTAT_OBS-VAL")), 15, 2)).alias("of_file"))


@query(sql("select 2000 as res, x // 2000 * 2000 as x, y // 2000 * 2000 as y, cast(sum(pop) as bigint) as pop from pop group by all union all select 5000, x // 5000 * 5000, y // 5000 * 5000, cast(sum(pop) as bigint) from pop group by all union all select 10000, x // 10000 * 10000, y // 10000 * 10000, cast(sum(pop) as bigint) from pop group by all", "pop"))
def grid_sum_pyramid(spark, sf):
    return grid.pyramid(X.pop_cells(spark, sf), list(grid.SCHEDULE[1000]), {"pop": F.sum("pop")})


def _resampled(how):
    def run(spark, sf):
        made = grid.resample(X.pop_cells(spark, sf).withColumnRenamed("pop", "value"), 1000, 5000, how=how)
        return made.select("x", "y", F.bround(c("value").cast("double"), 4).alias("value"))

    return run


for _how, _fn in (("average", "avg"), ("sum", "sum"), ("median", "median")):
    QUERIES[f"grid_resample_{_how}"] = _resampled(_how)
    ORACLE[f"grid_resample_{_how}"] = sql(f"select x // 5000 * 5000 as x, y // 5000 * 5000 as y, round_even(cast({_fn}(pop) as double), 4) as value from pop group by all", "pop")


@query(sql("select min(x) as minx, min(y) as miny, max(x) + 1000 as maxx, max(y) + 1000 as maxy from pop", "pop"))
def grid_extent(spark, sf):
    return grid.extent(X.pop_cells(spark, sf), 1000)


@query(sql("select id, x, y from pop where x between 4010000 and 4030000 and y between 3005000 and 3020000", "pop"))
def grid_crop(spark, sf):
    return grid.crop(X.pop_cells(spark, sf), 4010000, 3005000, 4030000, 3020000).select("id", "x", "y")


@query(sql("select x // 5000 * 5000 as x, y // 5000 * 5000 as y, sum(pop)::bigint as pop, sum(case when code < 12 then pop else 0 end)::bigint as part, round_even(sum(case when code < 12 then pop else 0 end) / nullif(sum(pop), 0)::double * 100, 6) as share from pop group by all", "pop"))
def ratio_after_aggregation(spark, sf):
    made = grid.aggregate_cells(X.pop_cells(spark, sf), 5000, {"pop": F.sum("pop"), "part": F.sum(F.when(c("code") < 12, c("pop")).otherwise(0))})
    return made.withColumn("share", F.bround(grid.ratio(c("part"), c("pop")), 6))


_AGG = "case when count(*) filter (v = '') > 0 then null when count(*) filter (v not in ('0', '')) = 0 then 0 when count(*) filter (v not in ('0', '', '-1')) = 0 then -1 else sum(try_cast(v as bigint)) filter (v not in ('0', '', '-1')) end"
_SENTINEL = "case when {k} % 97 = 0 then '' when {k} % 3 = 0 then '0' when {k} % 3 = 1 and {k} % 5 < 3 then '-1' else cast({k} % 50 as {s}) end"


@query(sql(f"select x // 5000 * 5000 as x, y // 5000 * 5000 as y, cast({_AGG} as bigint) as total from (select x, y, {_SENTINEL.format(k='id', s='varchar')} as v from pop) group by all", "pop"))
def grid_confidential_sum(spark, sf):
    rows = X.pop_cells(spark, sf).selectExpr("x", "y", _SENTINEL.format(k="id", s="string") + " as v")
    return grid.aggregate_cells(rows, 5000, {"total": S.confidential_sum(c("v"))})


@query(sql("select id, x, y, x // 1000 // 16 as tx, y // 1000 // 16 as ty, x // 1000 % 16 as col, y // 1000 % 16 as row from pop", "pop"))
def tile_assign(spark, sf):
    return grid.assign_tiles(X.pop_cells(spark, sf), 1000, 16).select("id", "x", "y", "tx", "ty", "col", "row")


@query(sql("select x, y, a, b, x // 5000 // 4 as tx, y // 5000 // 4 as ty, x // 5000 % 4 as col, y // 5000 % 4 as row from (select x // 5000 * 5000 as x, y // 5000 * 5000 as y, nullif(round_even(avg(pop) filter (code < 12), 0), 0) as a, round_even(avg(pop) filter (code >= 12), 0) as b from pop group by all) where a is not null or b is not null", "pop"))
def tile_raster(spark, sf):
    cells = X.pop_cells(spark, sf).withColumnRenamed("pop", "value")
    bands = {"a": cells.where("code < 12"), "b": cells.where("code >= 12")}
    made = {n: grid.resample(df, 1000, 5000).withColumn("value", F.bround("value")) for n, df in bands.items()}
    return grid.tile_bands(made, 5000, 4, {"a": [0, None]}).select("x", "y", "a", "b", "tx", "ty", "col", "row")


@query(sql("select a.id, a.x, a.y, coalesce(b.pop, 0) as pop from poi a left join (select x, y, max(pop) as pop from pop group by 1, 2) b on a.x - 500 = b.x and a.y - 500 = b.y", "pop", "poi"))
def lookup_join_default(spark, sf):
    points = X.pois(spark, sf).withColumn("grd_id", C.cell_id(c("x") - 500, c("y") - 500, 1000))
    values = X.pop_cells(spark, sf).groupBy(C.cell_id(c("x"), c("y"), 1000).alias("grd_id")).agg(F.max("pop").alias("pop"))
    return spatial.lookup(points, values, "grd_id", "pop", 0).select("id", "x", "y", "pop")


@query(sql("select id, xmin, ymin, case when whole > 0 then round_even(pop * area / whole, 2) when pop is not null then 0.0 end as allocated from (select b.id, xmin, ymin, residential * (xmax - xmin) * floor_nb as area, sum(residential * (xmax - xmin) * floor_nb) over (partition by xmin // 1000, ymin // 1000) as whole, p.pop from buildings b left join (select x, y, cast(sum(pop) as double) as pop from pop group by 1, 2) p on b.xmin // 1000 * 1000 = p.x and b.ymin // 1000 * 1000 = p.y)", "pop", "buildings"))
def hierarchical_allocation(spark, sf):
    children = X.buildings(spark, sf).withColumns({"x": C.snap(c("xmin"), 1000), "y": C.snap(c("ymin"), 1000), "area": c("residential") * (c("xmax") - c("xmin")) * c("floor_nb")})
    parents = X.pop_cells(spark, sf).groupBy("x", "y").agg(F.sum("pop").cast("double").alias("pop"))
    return grid.allocate_grouped(children, parents, ["x", "y"], "area", "pop").select("id", "xmin", "ymin", "allocated")


# census


@query(sql("select rule, GRD_ID, cast(len(e) as int) as nb_errors, array_to_string(e, ',') as errors from (select GRD_ID, unnest([{'rule': 'populated_consis', 'e': case when (POPULATED = 1 and T = 0) or (POPULATED = 0 and T <> 0) then ['POPULATED_T_inconsistency_POPULATED=' || POPULATED || '_T=' || T] else [] end}, {'rule': 'pop_values_none', 'e': case when F is null then ['F_none_value=None'] else [] end}, {'rule': 'pop_values_non_neg', 'e': list_filter([case when F < 0 and F <> -9999 then 'F_negative_value=' || F end, case when EMP < 0 and EMP <> -9999 then 'EMP_negative_value=' || EMP end], lambda z: z is not null)}, {'rule': 'emp_smaller_than_pop', 'e': case when EMP > T then ['EMP_T_inconsistency_EMP=' || EMP || '_T=' || T] else [] end}, {'rule': 'ci_val', 'e': case when F_CI is not null and F_CI <> -9999 then ['F_CI_value=' || F_CI] else [] end}, {'rule': 'ci_consis', 'e': case when not (coalesce(F_CI = -9999 and F = -9999, false) or (F_CI is null and F is distinct from -9999)) then ['F_CI_inconsistency_ci=' || coalesce(F_CI::varchar, 'None') || '_value=' || coalesce(F::varchar, 'None')] else [] end}, {'rule': 'cat_sum_sex', 'e': case when not (M + coalesce(nullif(F, -9999), 0) = T or (F_CI is not distinct from -9999 and M + coalesce(nullif(F, -9999), 0) <= T)) then ['SEX_sum_T=' || T || '_SUM=' || (M + coalesce(nullif(F, -9999), 0))] else [] end}], recursive := true) from census) where len(e) > 0", "census"))
def census_rules_each(spark, sf):
    return S.validate_each(X.census(spark, sf))


@query(sql("select GRD_ID, cast(len(e) as int) as nb_errors, array_to_string(e, ',') as errors from (select GRD_ID, list_filter([case when F_CI is not null and F_CI <> -9999 then 'F_CI_value=' || F_CI end, case when not (coalesce(F_CI = -9999 and F = -9999, false) or (F_CI is null and F is distinct from -9999)) then 'F_CI_inconsistency_ci=' || coalesce(F_CI::varchar, 'None') || '_value=' || coalesce(F::varchar, 'None') end, case when (POPULATED = 1 and T = 0) or (POPULATED = 0 and T <> 0) then 'POPULATED_T_inconsistency_POPULATED=' || POPULATED || '_T=' || T end, case when F is null then 'F_none_value=None' end, case when F < 0 and F <> -9999 then 'F_negative_value=' || F end, case when EMP < 0 and EMP <> -9999 then 'EMP_negative_value=' || EMP end, case when EMP > T then 'EMP_T_inconsistency_EMP=' || EMP || '_T=' || T end, case when not (M + coalesce(nullif(F, -9999), 0) = T or (F_CI is not distinct from -9999 and M + coalesce(nullif(F, -9999), 0) <= T)) then 'SEX_sum_T=' || T || '_SUM=' || (M + coalesce(nullif(F, -9999), 0)) end], lambda z: z is not null) as e from census) where len(e) > 0", "census"))
def census_rules_combined(spark, sf):
    return S.validate(X.census(spark, sf))


_FLAG = "case when {k} % 7 = 0 then '-9999' when {k} % 7 = 1 then '0' when {k} % 7 = 2 then '-9986' else '' end"
_SAID = "case when {k} % 5 = 0 then '-9999' else cast({k} % 30 as {s}) end"


@query(f"select x, y, T, case when ci = '-9999' and v = '-9999' then '-1' when ci = '-9999' and v <> '-9999' then v when ci = '0' and v <> '-9999' then v when ci = '' and v = '-9999' then '-1' when ci = '-9986' then '-1' else v end as M from (select 4000000::bigint as x, 3000000 + c_custkey * 1000 as y, cast(c_custkey % 4 as varchar) as T, {_SAID.format(k='c_custkey', s='varchar')} as v, {_FLAG.format(k='c_custkey')} as ci from customer) where T <> '0'")
def census_confidential_normalise(spark, sf):
    rows = table(spark, sf, "customer").selectExpr("concat('CRS3035RES1000mN', 3000000 + c_custkey * 1000, 'E4000000') as GRD_ID", "cast(c_custkey % 4 as string) as T", _SAID.format(k="c_custkey", s="string") + " as M", _FLAG.format(k="c_custkey") + " as M_CI", "1 as POPULATED")
    return S.normalise(rows, ["M"]).select("x", "y", "T", "M")


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("select o_custkey as cell, " + ", ".join(f"count(*) filter (o_orderpriority = '{p}')::bigint as p{i}" for i, p in enumerate(_PRIORITIES)) + " from orders group by 1")
def census_pivot(spark, sf):
    long = table(spark, sf, "orders").groupBy(c("o_custkey").alias("SPATIAL"), c("o_orderpriority").alias("STAT")).agg(F.count("*").alias("OBS_VALUE"))
    wide = S.pivot_statistics(long, names=_PRIORITIES)
    return wide.select(c("SPATIAL").alias("cell"), *[F.coalesce(c(f"`{p}`"), F.lit(0)).alias(f"p{i}") for i, p in enumerate(_PRIORITIES)])


@query(sql("select id, x, y, null::bigint as code from pop where code < 3 union all select id, x, y, code from poi where code >= 20", "pop", "poi"))
def census_concat(spark, sf):
    return X.pop_cells(spark, sf).where("code < 3").select("id", "x", "y").unionByName(X.pois(spark, sf).where("code >= 20").withColumn("code", c("code").cast("long")), allowMissingColumns=True)


@query(sql("select GRD_ID, T, M, F from census", "census"))
def census_theme_split(spark, sf):
    return S.theme(X.census(spark, sf), "sex", ["GRD_ID"])


# rasters


@query(sql("select row, col, x, y, value from (select (3040000 - y) // 1000 - 1 as row, (x - 4000000) // 1000 as col, x, y, max_by(pop, id) as value from pop group by x, y) where value >= 100", "pop"))
def pixels_from_cells(spark, sf):
    made = raster.from_cells(X.pop_cells(spark, sf), 4000000, 3040000, 1000, 60, 40, value="pop", order="id")
    x, y = C.pixel_corner(c("row"), c("col"), 4000000, 3040000, 1000)
    return made.where("value >= 100").select("row", "col", x.cast("long").alias("x"), y.cast("long").alias("y"), "value")


@query(sql("select x, y, max_by(pop, id) as value from pop group by x, y having max_by(pop, id) between 500 and 900", "pop"))
def cells_from_pixels(spark, sf):
    made = raster.from_cells(X.pop_cells(spark, sf), 4000000, 3040000, 1000, 60, 40, value="pop", order="id")
    return raster.to_rows(made, 4000000, 3040000, 1000, keep=c("value").between(500, 900))


def _bands(spark, sf):
    cells = X.pop_cells(spark, sf).groupBy("x", "y").agg(F.sum("pop").alias("value"), F.min("code").alias("code"))
    return {"a": cells.where("code % 3 > 0"), "b": cells.where("code % 2 = 0")}


_BANDS = "cells as (select x, y, sum(pop)::bigint as value, min(code) as code from pop group by 1, 2), a as (select x, y, value as a from cells where code % 3 > 0), b as (select x, y, value as b from cells where code % 2 = 0), ab as (select * from a full join b using (x, y))"


def _band_sql(body: str) -> str:
    return f"with pop as ({X.CTES['pop']}), zones as ({X.CTES['zones']}), {_BANDS} {body}"


@query(_band_sql("select x, y, a, b from ab"))
def band_combine(spark, sf):
    return raster.combine_bands(_bands(spark, sf)).select("x", "y", "a", "b")


@query(_band_sql("select x, y, round_even(a / nullif(b, 0)::double * 100, 6) as ratio, cast(trunc(a / nullif(b, 0)::double * 100) as bigint) as whole from ab"))
def band_ratio(spark, sf):
    both = raster.combine_bands(_bands(spark, sf))
    return both.select("x", "y", F.bround(grid.ratio(c("a"), c("b")), 6).alias("ratio"), grid.ratio(c("a"), c("b"), whole=True).alias("whole"))


def _masked(invert):
    def run(spark, sf):
        both = raster.combine_bands(_bands(spark, sf))
        covered = raster.covered_by_boxes(both, X.zones(spark, sf).where("region in (1, 3)").select("xmin", "ymin", "xmax", "ymax"), 1000)
        return raster.mask(both, covered, ["a", "b"], invert).select("x", "y", "a", "b")

    return run


for _name, _not in (("band_mask", ""), ("band_mask_invert", "not")):
    _in = f"{_not} exists (select 1 from zones z where region in (1, 3) and x < xmax and x + 1000 > xmin and y < ymax and y + 1000 > ymin)"
    QUERIES[_name] = _masked(_not == "not")
    ORACLE[_name] = _band_sql(f"select x, y, case when {_in} then a end as a, case when {_in} then b end as b from ab")


@query(_band_sql("select r.x, g.y, a from (select unnest(range(3995000, 4010000, 1000)) as x) r cross join (select unnest(range(2998000, 3006000, 1000)) as y) g left join a on a.x = r.x and a.y = g.y"))
def crop_extend(spark, sf):
    return raster.crop_extend(raster.combine_bands({"a": _bands(spark, sf)["a"]}), 3995000, 2998000, 4010000, 3006000, 1000)


@query(_band_sql("select x, y, a as first, b as second from ab"))
def band_rename(spark, sf):
    return raster.rename_bands(raster.combine_bands(_bands(spark, sf)), ["first", "second"])


@query(sql("select z.code, sum(pop)::bigint as total, round_even(avg(pop), 6) as mean, max(pop) as most, min(pop) as least, count(pop)::bigint as n from zones z left join pop p on p.x + 500 >= xmin and p.x + 500 < xmax and p.y + 500 >= ymin and p.y + 500 < ymax group by 1", "pop", "zones"))
def zonal_stats(spark, sf):
    made = raster.zonal_stats(X.pop_cells(spark, sf).withColumnRenamed("code", "land"), X.zones(spark, sf), "code", {"total": F.sum("pop"), "mean": F.bround(F.avg("pop"), 6), "most": F.max("pop"), "least": F.min("pop"), "n": F.count("pop")}, 1000)
    return made.withColumn("n", F.coalesce("n", F.lit(0)))


@query(sql("select z.code, coalesce(sum(pop) filter (p.code between 0 and 9), 0)::double as low, coalesce(sum(pop) filter (p.code between 9 and 24), 0)::double as high from zones z left join pop p on p.x + 500 >= xmin and p.x + 500 < xmax and p.y + 500 >= ymin and p.y + 500 < ymax group by 1", "pop", "zones"))
def zonal_class_sum(spark, sf):
    pixels = X.pop_cells(spark, sf).select("x", "y", c("pop").alias("value"), c("code").alias("class"))
    return raster.zonal_class_sum(pixels, X.zones(spark, sf), "code", {"low": (0, 9), "high": (9, 24)}, 1000)


@query(sql("select cx as x, cy as y, max_by(floor_nb, id) as value from (select *, unnest(range(xmin // 50 * 50, xmax, 50)) as cx from buildings) b, unnest(range(ymin // 50 * 50, ymax, 50)) t(cy) where cx + 25 >= xmin and cx + 25 < xmax and cy + 25 >= ymin and cy + 25 < ymax group by 1, 2", "buildings"))
def rasterise(spark, sf):
    return raster.rasterise_boxes(X.buildings(spark, sf), 50, "floor_nb", "id")


@query("with recursive pop as (" + X.CTES["pop"] + "), px as (select x, y, y * 10000000 + x as node from pop group by 1, 2 having max(pop) >= 500), e as (select a.node as u, b.node as v from px a join px b on abs(a.x - b.x) + abs(a.y - b.y) = 1000), r(node, root) using key (node) as (select node, node from px union select e.v, min(r.root) from r join e on e.u = r.node left join recurring.r k on k.node = e.v where r.root < k.root group by 1) select px.x, px.y, r.root % 10000000 as px, r.root // 10000000 as py from px join r using (node)")
def raster_patches(spark, sf):
    pixels = X.pop_cells(spark, sf).groupBy("x", "y").agg(F.max("pop").cast("double").alias("value"))
    return raster.patches(pixels, 1000, least=500.0, equal=False).select("x", "y", c("patch.x").alias("px"), c("patch.y").alias("py"))


# joins by place


@query(sql("select a.id, cast(round_even(sum(b.pop), 0) as bigint) as nearby from pop a join pop b on (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 5000 * 5000 group by 1", "pop"))
def radius_population(spark, sf):
    return spatial.radius_sum(X.pop_cells(spark, sf), 5000, "pop")


@query(sql("select a.id, cast(round_even(sum(b.pop), 0) as bigint) as nearby from pop a join pop b on a.code = b.code and (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 12000 * 12000 group by 1", "pop"))
def radius_population_same_land(spark, sf):
    return spatial.radius_sum(X.pop_cells(spark, sf), 12000, "pop", ["code"])


@query(sql("select id, target, round(sqrt(d2), 4) as distance from (select a.id, arg_min(b.id, (a.x + 500 - b.x) * (a.x + 500 - b.x) + (a.y + 500 - b.y) * (a.y + 500 - b.y) + b.id / 1e6) as target, min((a.x + 500 - b.x) * (a.x + 500 - b.x) + (a.y + 500 - b.y) * (a.y + 500 - b.y)) as d2 from pop a, poi b group by 1)", "pop", "poi"))
def nearest_snap(spark, sf):
    centres = X.pop_cells(spark, sf).select("id", (c("x") + 500).alias("x"), (c("y") + 500).alias("y"))
    return spatial.nearest(centres, X.pois(spark, sf), 2000.0).select("id", "target", F.round("distance", 4).alias("distance"))


@query(sql("select id, box, round(sqrt(d2), 4) as distance from (select id, box, d2, min(d2) over (partition by id) as least from (select p.id, z.code as box, greatest(z.xmin - p.x, 0, p.x - z.xmax) ** 2 + greatest(z.ymin - p.y, 0, p.y - z.ymax) ** 2 as d2 from pop p, zones z)) where d2 = least and d2 <= 3000 * 3000 union all select id, null, null from pop p where not exists (select 1 from zones z where greatest(z.xmin - p.x, 0, p.x - z.xmax) ** 2 + greatest(z.ymin - p.y, 0, p.y - z.ymax) ** 2 <= 3000 * 3000)", "pop", "zones"))
def nearest_with_distance(spark, sf):
    boxes = X.zones(spark, sf).withColumnRenamed("code", "box")
    return spatial.nearest_boxes(X.pop_cells(spark, sf), boxes, 4000.0, 3000.0).select("id", "box", F.round("distance", 4).alias("distance"))


@query(sql("select p.id, z.code as zone from poi p left join zones z on p.x > xmin and p.x < xmax and p.y > ymin and p.y < ymax ", "poi", "zones"))
def point_in_zone(spark, sf):
    boxes = X.zones(spark, sf).withColumnRenamed("code", "zone")
    return spatial.points_in_boxes(X.pois(spark, sf), boxes, 4000.0).select("id", "zone")


@query(sql("select p.id, coalesce(string_agg(distinct z.code, '-' order by z.code), '') as codes from pop p left join zones z on greatest(z.xmin - (p.x + 1000), 0, p.x - z.xmax) ** 2 + greatest(z.ymin - (p.y + 1000), 0, p.y - z.ymax) ** 2 <= 1500 * 1500 group by 1", "pop", "zones"))
def region_codes_within(spark, sf):
    return spatial.codes_within(X.pop_cells(spark, sf), X.zones(spark, sf), 1000, 1500.0, 6000.0)


@query(sql("select a.id as a, b.id as b, round(sqrt((a.x + 500 - b.x) ** 2 + (a.y + 500 - b.y) ** 2), 4) as distance from pop a, poi b where (a.x + 500 - b.x) ** 2 + (a.y + 500 - b.y) ** 2 <= 5000 * 5000", "pop", "poi"))
def pairs_within_distance(spark, sf):
    left = X.pop_cells(spark, sf).select("id", (c("x") + 500).alias("x"), (c("y") + 500).alias("y"))
    return spatial.pairs_within(left, X.pois(spark, sf), 5000.0).select("a", "b", F.round("distance", 4).alias("distance"))


@query(sql("select a.id, a.code, round(sqrt(min((a.x - b.x) ** 2 + (a.y - b.y) ** 2)), 4) as distance from poi a left join poi b on a.code <> b.code and (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 1500 * 1500 group by 1, 2", "poi"))
def near_other_country(spark, sf):
    return spatial.near_other_group(X.pois(spark, sf), "code", 1500.0).select("id", "code", F.round("distance", 4).alias("distance"))


@query(sql("select a.id as a, b.id as b, (least(a.xmax, b.xmax) - greatest(a.xmin, b.xmin)) * (least(a.ymax, b.ymax) - greatest(a.ymin, b.ymin)) as area from buildings a join buildings b on a.id > b.id and a.xmin < b.xmax and b.xmin < a.xmax and a.ymin < b.ymax and b.ymin < a.ymax", "buildings"))
def overlap_pairs(spark, sf):
    return spatial.overlapping(X.buildings(spark, sf), 250.0)


_PARTS = "parts as (select *, (least(xmax, cx + 100) - greatest(xmin, cx)) * (least(ymax, cy + 100) - greatest(ymin, cy)) as area from (select *, unnest(range(xmin // 100 * 100, xmax, 100)) as cx from buildings) b, unnest(range(ymin // 100 * 100, ymax, 100)) t(cy))"
_USES = ", ".join(f"round_even(sum(area * {u}), 0)::double as {n}_ground_area, round_even(sum(area * floor_nb * {u}), 0)::double as {n}_floor_area" for n, u in (("residential", "residential"), ("economic_activity", "activity"), ("cultural", "cultural_value")))


@query(f"select * exclude (hundredths, rest), (hundredths + case when rest > 5000000 or (rest = 5000000 and hundredths % 2 = 1) then 1 else 0 end) / 100::double as number from (with buildings as ({X.CTES['buildings']}), {_PARTS} select cx as x, cy as y, cast(floor(sum(cast(floor(least(area / ((xmax - xmin) * (ymax - ymin))::double, 1) * 1e9::double + 0.5) as bigint)) / 1e7::double) as bigint) as hundredths, cast(sum(cast(floor(least(area / ((xmax - xmin) * (ymax - ymin))::double, 1) * 1e9::double + 0.5) as bigint)) as bigint) % 10000000 as rest, round_even(sum(area), 0)::double as ground_area, round_even(sum(area * floor_nb), 0)::double as floor_area, {_USES} from parts group by 1, 2)")
def building_grid(spark, sf):
    return D.building_grid(X.buildings(spark, sf), 100)


@query(f"with buildings as ({X.CTES['buildings']}), {_PARTS} select id, cx, cy, area from parts where area > 0")
def grid_overlay(spark, sf):
    return spatial.overlay_cells(X.buildings(spark, sf), 100).select("id", "cx", "cy", "area")


# filters


@query("select o_orderkey as id, o_orderpriority as p from orders where o_orderpriority in ('1-URGENT', '5-LOW') or o_orderpriority like '%HIGH%'")
def code_filters(spark, sf):
    rows = table(spark, sf, "orders").selectExpr("o_orderkey as id", "o_orderpriority as p")
    return rows.where(F.arrays_overlap(F.array("p"), F.array(F.lit("1-URGENT"), F.lit("5-LOW"))) | F.coalesce(c("p").rlike("HIGH"), F.lit(False)))


_LINK = "case when {k} % 5 = 0 then null when {k} % 5 = 1 then 'tractor_road' when {k} % 5 = 2 then 'motorway' else 'single_carriage_way' end as form_of_way, case when {k} % 7 = 0 then 'private' when {k} % 7 = 1 then null else 'public' end as access_restriction, case when {k} % 11 = 0 then 'disused' else 'in_use' end as condition_of_facility"


@query(f"select id from (select o_orderkey as id, {_LINK.format(k='o_orderkey')} from orders) where form_of_way is distinct from 'tractor_road' and access_restriction is distinct from 'private' and condition_of_facility is distinct from 'disused'")
def null_safe_exclusion_filter(spark, sf):
    rows = table(spark, sf, "orders").selectExpr("o_orderkey as id", "o_orderkey as k")
    rows = rows.withColumns({"form_of_way": F.expr("case when k % 5 = 0 then null when k % 5 = 1 then 'tractor_road' when k % 5 = 2 then 'motorway' else 'single_carriage_way' end"), "access_restriction": F.expr("case when k % 7 = 0 then 'private' when k % 7 = 1 then null else 'public' end"), "condition_of_facility": F.expr("case when k % 11 = 0 then 'disused' else 'in_use' end")})
    return rows.where(R.link_usable({n: c(n) for n in R.UNUSABLE})).select("id")


# tags and roads

_TAGS = "concat('\"name\"=>\"', event_type, '\",\"highway\"=>\"', case user_id % 5 when 0 then 'motorway' when 1 then 'primary' when 2 then 'residential' when 3 then 'path' else 'odd' end, '\"', case user_id % 4 when 0 then ',\"building:levels\"=>\"3\"' when 1 then ',\"height\"=>\"~9,0\"' when 2 then ',\"building:levels\"=>\"x\"' else '' end)"


@query("select event_id as id, event_type as name, case user_id % 5 when 0 then 'motorway' when 1 then 'primary' when 2 then 'residential' when 3 then 'path' else 'odd' end as highway, cast(null as varchar) as ref from events")
def hstore_tags(spark, sf):
    return T.with_tags(table(spark, sf, "events").select(c("event_id").alias("id"), F.expr(_TAGS).alias("tags")), "tags", ["name", "highway", "ref"]).drop("tags")


@query("select event_id as id, case user_id % 5 when 0 then 110 when 1 then 80 when 2 then 30 when 3 then 5 else 30 end as kmh from events")
def osm_speed(spark, sf):
    return table(spark, sf, "events").select(c("event_id").alias("id"), T.road_class_kmh(T.tag(F.expr(_TAGS), "highway")).alias("kmh"))


@query("select event_id as id, case user_id % 4 when 0 then 3.0::double when 1 then 3.0::double else 1.0::double end as floors from events")
def osm_floors(spark, sf):
    return table(spark, sf, "events").select(c("event_id").alias("id"), T.floors_from_tags(F.expr(_TAGS)).alias("floors"))


_SECTION = {
    "fow": "case when {k} % 23 = 0 then -1 else cast({k} % 22 as int) end",
    "feature": "case when {k} % 23 = 0 then 4130 else 4110 end",
    "pos": "case when {l} % 3 = 0 then null else cast(20 + {k} % 90 as double) end",
    "neg": "case when {l} % 3 = 0 or {l} % 4 = 1 then null else cast(30 + {k} % 70 as double) end",
    "kph": "case when {k} % 2 = 0 then 0 else cast({k} % 50 as int) end",
    "metres": "cast(100 + {k} % 1000 as double)",
}


def _sections(spark, sf):
    return table(spark, sf, "lineitem").selectExpr("l_orderkey as id", "l_linenumber as line", *[v.format(k="l_orderkey", l="l_linenumber") + f" as {n}" for n, v in _SECTION.items()], "cast(l_orderkey % 9 as int) as freeway", "cast(l_orderkey % 25 as int) as fb", "cast(null as int) as tb")


_SECTIONS = "sections as (select l_orderkey as id, l_linenumber as line, " + ", ".join(v.format(k="l_orderkey", l="l_linenumber") + f" as {n}" for n, v in _SECTION.items()) + ", cast(l_orderkey % 9 as int) as freeway, cast(l_orderkey % 25 as int) as fb from lineitem)"


@query(f"with {_SECTIONS} select id, line, metres, round(case when ferry then metres / 20 * 3.6 when fow in (19, 20) then null when fow in (14, 15, 17, 18) then metres / 10 * 3.6 when pos is null and neg is null then metres / (case when kph > 0 then kph else 10 end) * 3.6 else metres / pos * 3.6 end, 6) as forward, round(case when ferry then metres / 20 * 3.6 when fow in (19, 20) then null when fow in (14, 15, 17, 18) then metres / 10 * 3.6 when pos is null and neg is null then metres / (case when kph > 0 then kph else 10 end) * 3.6 else metres / neg * 3.6 end, 6) as backward from (select *, fow = -1 and feature = 4130 as ferry from sections)")
def road_weight_time(spark, sf):
    w = R.travel_times(c("fow"), c("feature"), c("pos"), c("neg"), c("kph"), c("metres"))
    return _sections(spark, sf).select("id", "line", "metres", w.alias("w")).select("id", "line", "metres", F.round("w.forward", 6).alias("forward"), F.round("w.backward", 6).alias("backward"))


@query(f"with {_SECTIONS} select id, line, case when ferry or fow in (14, 15, 17, 18) then metres when fow in (19, 20) then null when pos is null and neg is null then metres when pos is not null then metres end as forward, case when ferry or fow in (14, 15, 17, 18) then metres when fow in (19, 20) then null when pos is null and neg is null then metres when neg is not null then metres end as backward from (select *, fow = -1 and feature = 4130 as ferry from sections)")
def road_weight_length(spark, sf):
    w = R.travel_lengths(c("fow"), c("feature"), c("pos"), c("neg"), c("metres"))
    return _sections(spark, sf).select("id", "line", w.alias("w")).select("id", "line", "w.forward", "w.backward")


@query(f"with {_SECTIONS} select id, line, not (fow in (1, 10, 19, 20, 21) or freeway = 1 or (fow = -1 and feature = 4130) or fb in (1, 2, 11, 12, 21, 22)) as snappable from sections")
def road_snappable(spark, sf):
    return _sections(spark, sf).select("id", "line", (~R.not_snappable(c("fow"), c("feature"), c("freeway"), c("fb"), c("tb"))).alias("snappable"))


_HARMONISED = {"surface": "case when {k} % 6 = 0 then 'unpaved' when {k} % 13 = 0 then null else 'paved' end", "form": "case when {k} % 4 = 0 then 'motorway' when {k} % 4 = 1 then 'slip_road' else 'other' end", "class": "case {k} % 5 when 0 then 'main_road' when 1 then 'local#second_class' when 2 then 'third_class' when 3 then null else 'fifth_class' end"}


@query("select id, kmh, round(1000 / kmh::double * 3.6, 6) as seconds from (select id, case when surface is distinct from 'paved' then 20 when form = 'motorway' then 120 when form = 'slip_road' then 80 when class = 'main_road' then 80 when class like '%second_class%' then 70 when class like '%third_class%' then 50 else 30 end as kmh from (select o_orderkey as id, " + ", ".join(v.format(k="o_orderkey") + f" as {n}" for n, v in _HARMONISED.items()) + " from orders))")
def harmonised_speed(spark, sf):
    rows = table(spark, sf, "orders").selectExpr("o_orderkey as id", *[v.format(k="o_orderkey") + f" as {n}" for n, v in _HARMONISED.items()])
    made = rows.withColumn("kmh", R.link_kmh(c("surface"), c("form"), c("class")))
    return made.select("id", "kmh", F.round(R.seconds(c("kmh"), F.lit(1000)), 6).alias("seconds"))


# geometry

_LINE = "array(array(double(p_partkey % 100), 0D), array(double(p_partkey % 100), double(10 * p_size)), array(double(p_partkey % 100 + 50), double(10 * p_size)))"
_LINE_SQL = "[[x, 0.0], [x, s], [x + 50, s]]"


@query("with l as (select p_partkey as id, (p_partkey % 100)::double as x, (10 * p_size)::double as s from part), n as (select *, greatest(ceil(s / 100)::int, 1) as n from l) select id, i as place, round(px, 6) as x, round(py, 6) as y from (select id, i::int as i, x as px, s * i / n as py from n, unnest(range(0, n)) t(i) union all select id, n, x, s from n union all select id, n + 1, x + 50, s from n)")
def densify(spark, sf):
    made = table(spark, sf, "part").select(c("p_partkey").alias("id"), F.posexplode(G.densify(F.expr(_LINE), 100.0)).alias("place", "p"))
    return made.select("id", "place", F.round(c("p")[0], 6).alias("x"), F.round(c("p")[1], 6).alias("y"))


@query("select p_partkey as id, 0 as place, 10.0::double * p_size as length from part union all select p_partkey, 1, 50.0 from part")
def line_segments(spark, sf):
    made = table(spark, sf, "part").select(c("p_partkey").alias("id"), F.posexplode(G.segments(F.expr(_LINE))).alias("place", "s"))
    return made.select("id", "place", G.point_distance(c("s")[0], c("s")[1]).alias("length"))


@query("select p_partkey as id, 2 as points, 10.0::double * p_size as length from part")
def line_chunks(spark, sf):
    made = table(spark, sf, "part").select(c("p_partkey").alias("id"), F.explode(G.chunks(F.expr(_LINE), 2)).alias("l"))
    return made.select("id", F.size("l").alias("points"), G.line_length(c("l")).alias("length"))


@query(sql("select id, (xmax - xmin) * (ymax - ymin)::double as area, 2.0::double * (xmax - xmin + ymax - ymin) as outline, (xmin + xmax) / 2.0::double as cx, (ymin + ymax) / 2.0::double as cy, xmin + 1 < xmax as inside from buildings", "buildings"))
def geometry_measures(spark, sf):
    ring = G.box_ring(c("xmin") - 4000000, c("ymin") - 3000000, c("xmax") - 4000000, c("ymax") - 3000000)
    made = X.buildings(spark, sf).select("id", "xmin", "ymin", ring.alias("r"))
    centre = G.ring_centroid(c("r"))
    return made.select("id", G.polygon_area(F.array("r")).alias("area"), G.line_length(c("r")).alias("outline"), (F.round(centre[0], 4) + 4000000).alias("cx"), (F.round(centre[1], 4) + 3000000).alias("cy"), G.point_in_polygon(c("xmin") - 4000000 + 1.0, c("ymin") - 3000000 + 1.0, F.array("r")).alias("inside"))


@query(f"with buildings as ({X.CTES['buildings']}), {_PARTS} select id, cx, cy, area::double as area from parts where area > 0")
def polygon_cell_overlay(spark, sf):
    made = X.buildings(spark, sf).select("id", G.box_ring(c("xmin"), c("ymin"), c("xmax"), c("ymax")).alias("ring"))
    return G.overlay_polygons(made, 100).select("id", "cx", "cy", F.round("area", 3).alias("area"))


# networks


@query(sql("select * from edges", "edges"))
def graph_edges(spark, sf):
    return X.edges(spark, sf)


@query("select case when o = 0 then a else b end as src, case when o = 0 then b else a end as dst, round(min(w), 6) as w from (select c_custkey, (c_custkey % 30 * 100) || '_' || (c_custkey // 30 % 30 * 100) as a, (c_custkey % 30 * 100 + 100) || '_' || (c_custkey // 30 % 30 * 100) as b, 3.6::double * 100 / (10 + c_custkey % 50) as w from customer), (values (0), (1)) t(o) group by 1, 2")
def graph_from_sections(spark, sf):
    rows = table(spark, sf, "customer").selectExpr("c_custkey as id", "array(array(double(c_custkey % 30 * 100), double(c_custkey div 30 % 30 * 100)), array(double(c_custkey % 30 * 100 + 100), double(c_custkey div 30 % 30 * 100))) as line", "10 + c_custkey % 50 as kmh")
    w = R.seconds(c("kmh"), F.lit(100.0))
    made, _ = network.build_graph(rows, costs=F.struct(w.alias("forward"), w.alias("backward")))
    return made.groupBy("src", "dst").agg(F.round(F.min("w"), 6).alias("w"))


@query(sql("select node, count(*) as degree from (select distinct least(src, dst) as a, greatest(src, dst) as b from edges), unnest([a, b]) t(node) group by 1 having count(*) = 1", "edges"))
def graph_degree_one(spark, sf):
    return network.degrees(X.edges(spark, sf)).where("degree = 1")


_COMPONENTS = "e as (select src as u, dst as v from edges), ee as (select u, v from e union select v, u from e), r(node, component) using key (node) as (select distinct u, u from ee union select ee.v, min(r.component) from r join ee on ee.u = r.node left join recurring.r k on k.node = ee.v where r.component < k.component group by 1)"


@query(sql(_COMPONENTS + " select node, component from r", "edges", recursive=True))
def graph_components(spark, sf):
    return connected_components(X.edges(spark, sf))


@query(sql(_COMPONENTS + " select e.u as src, e.v as dst from e join r on r.node = e.u where component in (select component from r group by 1 having count(*) >= 5)", "edges", recursive=True))
def small_component_prune(spark, sf):
    return network.prune_small_components(X.edges(spark, sf), 5).select("src", "dst")


_LABELS = "sp(node, source, cost) using key (node, source) as (select node, node, 0::bigint from sources union select dst, source, min(nc) from (select e.dst, sp.source, sp.cost + e.w as nc from sp join edges e on e.src = sp.node left join recurring.sp r on r.node = e.dst and r.source = sp.source where r.cost is null or sp.cost + e.w < r.cost) group by 1, 2)"
_RANKED = "(select *, cast(row_number() over (partition by node order by cost, source) as int) as rank from sp)"


@query(sql(f"{_LABELS} select node, source, cost, rank from {_RANKED} where rank <= 3", "edges", "sources", recursive=True))
def k_nearest_sources(spark, sf):
    return paths.k_nearest(X.edges(spark, sf), X.sources(spark, sf), 3)


@query(sql(f"{_LABELS} select node, source, cost from {_RANKED} where rank = 1", "edges", "sources", recursive=True))
def nearest_source(spark, sf):
    return paths.nearest_source(X.edges(spark, sf), X.sources(spark, sf))


_REACHED = _LABELS.replace("where r.cost is null", "where sp.cost + e.w <= 25 and (r.cost is null").replace("< r.cost)", "< r.cost))")


@query(sql(f"{_REACHED} select source, sum(pop)::bigint as reachable from sp join pop on pop.id = sp.node group by 1", "edges", "sources", "pop", recursive=True))
def bounded_reach_population(spark, sf):
    amounts = X.pop_cells(spark, sf).select(c("id").alias("node"), c("pop").alias("amount"))
    return paths.reachable_sum(X.edges(spark, sf), X.sources(spark, sf), amounts, 25)


@query(sql(f"{_REACHED}, acc as (select source as id, sum(pop)::bigint as acc from sp join pop on pop.id = sp.node group by 1), near as (select a.id, sum(b.pop)::bigint as near from pop a join pop b on (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 20000 * 20000 group by 1) select id, acc, near, round_even(acc / nullif(near, 0)::double * 100, 6) as performance from acc join near using (id)", "edges", "sources", "pop", recursive=True))
def road_performance(spark, sf):
    amounts = X.pop_cells(spark, sf).select(c("id").alias("node"), c("pop").alias("amount"))
    reached = paths.reachable_sum(X.edges(spark, sf), X.sources(spark, sf), amounts, 25, "acc").withColumnRenamed("source", "id")
    near = spatial.radius_sum(X.pop_cells(spark, sf), 20000, "pop", name="near")
    return reached.join(near, "id").withColumn("performance", F.bround(grid.ratio(c("acc"), c("near")), 6))


@query(sql(f"{_LABELS}, ranked as {_RANKED}, wide as (select node, max(cost) filter (rank = 1) as c1, max(cost) filter (rank = 2) as c2, max(cost) filter (rank = 3) as c3 from ranked group by 1) select {CELL} as grd_id, 100::bigint as distance_to_node, round(coalesce(c1 + 10.0, -1), 4)::double as duration_1, round(coalesce(c2 + 10.0, -1), 4)::double as duration_2, round(coalesce(c3 + 10.0, -1), 4)::double as duration_3, round(coalesce((c1 + c2 + c3) / 3.0::double + 10.0, -1), 4) as duration_average from pop left join wide on wide.node = pop.id", "edges", "sources", "pop", recursive=True))
def accessibility_grid(spark, sf):
    labels = paths.k_nearest(X.edges(spark, sf), X.sources(spark, sf), 3)
    cells = X.pop_cells(spark, sf).select(C.cell_id(c("x"), c("y"), 1000).alias("grd_id"), c("id").alias("node"), F.lit(100.0).alias("distance"))
    made = paths.access_grid(cells, labels, 3, 1000, speed=10.0, limit=1500)
    return made.select("grd_id", "distance_to_node", *[F.round(n, 4).alias(n) for n in ("duration_1", "duration_2", "duration_3", "duration_average")])


# focal sums

_CELLS1 = "cells as (select x, y, code, sum(pop)::bigint as v from pop group by 1, 2, 3)"


@query(f"with pop as ({X.CTES['pop']}), cells as (select x, y, sum(pop)::bigint as v from pop group by 1, 2) select a.x, a.y, sum(b.v)::bigint as focal from cells a join cells b on (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 3000 * 3000 group by 1, 2")
def focal_sum_small(spark, sf):
    return focal.focal_sum_small(X.pop_cells(spark, sf), 1000, 3000, "pop")


@query(f"with pop as ({X.CTES['pop']}), cells as (select x, y, sum(pop)::bigint as v from pop group by 1, 2) select a.x, a.y, sum(b.v)::double as focal from cells a join cells b on (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 15000 * 15000 group by 1, 2")
def focal_sum(spark, sf):
    return focal.focal_sum(X.pop_cells(spark, sf), 1000, 15000, "pop")


@query(f"with pop as ({X.CTES['pop']}), {_CELLS1} select a.x, a.y, a.code::bigint as code, sum(b.v)::double as focal from cells a join cells b on a.code = b.code and (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 12000 * 12000 group by 1, 2, 3")
def focal_sum_per_code(spark, sf):
    return focal.focal_sum(X.pop_cells(spark, sf), 1000, 12000, "pop", code="code")


# classes, buildings, people


@query(sql("select id, case when t = 0 then null when s0 >= 0.15 and s1 <= 0.6 and s2 <= 0.25 then '0' when s1 >= 0.6 and s0 <= 0.15 and s2 <= 0.25 then '1' when s2 >= 0.25 and s0 <= 0.15 and s1 <= 0.6 then '2' when s0 <= 0.15 and s1 >= 0.6 and s2 >= 0.25 then 'm0' when s1 <= 0.6 and s0 >= 0.15 and s2 >= 0.25 then 'm1' when s2 <= 0.25 and s0 >= 0.15 and s1 >= 0.6 then 'm2' else 'unknown' end as class, round(power(least(t / 100.0::double, 1.0), 0.25) * 9 + 1, 6) as diameter from (select id, a + b + d as t, a / (a + b + d)::double as s0, b / (a + b + d)::double as s1, d / (a + b + d)::double as s2 from (select id, id % 13 as a, id % 41 as b, id % 17 as d from pop))", "pop"))
def trivariate_class(spark, sf):
    rows = X.pop_cells(spark, sf).selectExpr("id", "id % 13 as a", "id % 41 as b", "id % 17 as d")
    cls = K.trivariate_class([c("a"), c("b"), c("d")], (0.15, 0.6, 0.25))
    return rows.select("id", cls.alias("class"), F.round(K.circle_diameter(c("a") + c("b") + c("d"), 100.0, 1.0, 10.0), 6).alias("diameter"))


@query("select p_partkey as id, cast(ceil(p_retailprice / 100 / 3) as bigint) as floor_nb, case when u = 0 then 1.0 when u = 1 then 0.3 when u = 2 then 0.25 else 0 end::double as residential, case when u = 1 then 1.0 when u = 2 then 0.25 else 0 end::double as activity, case when u = 3 then 1.0 else 0 end::double as cultural_value from (select *, p_partkey % 4 as u from part)")
def building_harmonise(spark, sf):
    rows = table(spark, sf, "part").selectExpr("p_partkey as id", "p_retailprice / 100 as hauteur", "case p_partkey % 4 when 0 then 'Résidentiel' when 1 then 'Agricole' when 2 then 'Indifférencié' else 'Religieux' end as usage_1", "case p_partkey % 4 when 1 then 'Résidentiel' end as usage_2", "cast(null as string) as nature")
    return D.harmonise(rows, "fr").select("id", "floor_nb", "residential", "activity", "cultural_value")


_SOURCES = {
    "nl": (["p_retailprice / 100 as `3dbag_b3_height_lod12`", "case p_partkey % 4 when 0 then 'woonfunctie,winkelfunctie' when 1 then 'celfunctie' when 2 then 'woonfunctie' end as gebruiksdoel", "case p_partkey % 3 when 0 then 'kerk|overig' when 1 then 'klooster, abdij' end as top10nl_typegebouw"], "greatest(ceil(p_retailprice / 100 / 3), 1)", "[0.5, 0, 1, 0][p_partkey % 4 + 1]", "[0.5, 1, 0, 0][p_partkey % 4 + 1]", "[0.5, 1, 0][p_partkey % 3 + 1]"),
    "pl": (["cast(nullif(p_partkey % 6, 0) as int) as LKOND", "case p_partkey % 5 when 0 then 'Tak' else 'Nie' end as ZABYTEK", "case p_partkey % 4 when 0 then 'budynkiODwochMieszkaniach' when 1 then 'budynkiBiurowe' when 2 then 'budynkiKultuReligijnego' end as FUNOGBUD"], "coalesce(nullif(p_partkey % 6, 0), 1)", "[1, 0, 0, 0][p_partkey % 4 + 1]", "[0, 1, 0, 0][p_partkey % 4 + 1]", "case when p_partkey % 5 = 0 or p_partkey % 4 = 2 then 1 else 0 end"),
    "it": (["case p_partkey % 4 when 0 then '0101' when 1 then '0602' when 2 then '9301' else '0501' end as edifc_uso", "case p_partkey % 3 when 0 then '0300' else '0100' end as edifc_ty", "'02' as edifc_mon"], "1", "[1, 0, 0.25, 0][p_partkey % 4 + 1]", "[0, 1, 0.25, 0][p_partkey % 4 + 1]", "case when p_partkey % 4 = 3 or p_partkey % 3 = 0 then 1 else 0 end"),
    "lu": (["cast(case p_partkey % 4 when 0 then 0 when 1 then 41004 when 2 then 80000 else 50005 end as string) as NATURE", "250 + p_size as mean_z", "case p_partkey % 7 when 0 then -32767 else 250 end as dtm"], "case when p_partkey % 7 = 0 then 1 else ceil(p_size / 3.0::double) end", "[1, 0, 0, 0][p_partkey % 4 + 1]", "[0, 1, 1, 0][p_partkey % 4 + 1]", "[0, 1, 0, 1][p_partkey % 4 + 1]"),
    "at": (["p_retailprice / 5 as HOEHE_OBJEKT_MAX"], "case when p_retailprice / 5 > 300 then 1 else greatest(ceil(p_retailprice / 5 / 3), 1) end", "case when p_size < 25 then 1 else 0 end", "case when p_size < 25 then 0 else 1 end", "0"),
    "cz": (["p_size as size"], "1", "case when p_size < 25 then 1 else 0 end", "case when p_size < 25 then 0 else 1 end", "0"),
}


@query(" union all ".join(f"select '{n}' as source, p_partkey as id, cast({f} as bigint) as floor_nb, cast({r} as double) as residential, cast({a} as double) as activity, cast({v} as double) as cultural_value from part" for n, (_, f, r, a, v) in _SOURCES.items()))
def building_harmonise_sources(spark, sf):
    made = [D.harmonise(table(spark, sf, "part").selectExpr("p_partkey as id", "p_size", *fields), n, small=c("p_size") < 25).select(F.lit(n).alias("source"), "id", "floor_nb", "residential", "activity", "cultural_value") for n, (fields, *_) in _SOURCES.items()]
    return reduce(DataFrame.unionByName, made)


_PEOPLE = {"sex": ["sex_1", "sex_2"], "age": ["age_1", "age_2", "age_3"]}


def _units(spark, sf):
    return table(spark, sf, "nation").selectExpr("n_nationkey as unit", "cast(20 + n_nationkey as bigint) as total", "cast(12 as bigint) as sex_1", "cast(8 + n_nationkey as bigint) as sex_2", "cast(5 as bigint) as age_1", "cast(n_nationkey as bigint) as age_2", "cast(10 as bigint) as age_3")


@query("select n_nationkey as unit, 20 + n_nationkey::bigint as total, 12::bigint as sex_1, 8 + n_nationkey::bigint as sex_2, 5::bigint as age_1, n_nationkey::bigint as age_2, 10::bigint as age_3 from nation")
def synthetic_people_marginals(spark, sf):
    people = D.synthetic_people(_units(spark, sf), "unit", "total", _PEOPLE, seed=3)
    return D.people_statistics(people, ["unit"], _PEOPLE)


@query()
def dasymetric_grid(spark, sf):
    units = _units(spark, sf).join(table(spark, sf, "nation").selectExpr("n_nationkey as unit", "double(4000000 + (n_nationkey % 5) * 12000) as xmin", "double(3000000 + (n_nationkey div 5) * 8000) as ymin", "double(4012000 + (n_nationkey % 5) * 12000) as xmax", "double(3008000 + (n_nationkey div 5) * 8000) as ymax"), "unit")
    homes = X.buildings(spark, sf).where("residential = 1").selectExpr("double(xmin) as xmin", "double(ymin) as ymin", "double(xmax) as xmax", "double(ymax) as ymax")
    people = D.synthetic_people(units, "unit", "total", _PEOPLE, seed=3)
    placed = D.place_people(people, D.dasymetric_targets(units, homes, 4000.0), "unit", "total", threshold=22, seed=3)
    return D.people_to_grid(placed, 1000, _PEOPLE)


@query(sql("select x, y, round(sum(v), 4) as pop from (select cx as x, cy as y, pop * area / 1e6::double as v from (select *, (least(x + 1000, cx + 700) - greatest(x, cx)) * (least(y + 1000, cy + 700) - greatest(y, cy)) as area from (select *, unnest(range(x // 700 * 700, x + 1000, 700)) as cx from pop) p, unnest(range(y // 700 * 700, y + 1000, 700)) t(cy))) where v > 0 group by 1, 2", "pop"))
def dasymetric_area_shares(spark, sf):
    boxes = X.pop_cells(spark, sf).select("pop", c("x").alias("xmin"), c("y").alias("ymin"), (c("x") + 1000).alias("xmax"), (c("y") + 1000).alias("ymax"))
    return D.to_grid_by_area(boxes, 700, ["pop"]).withColumn("pop", F.round("pop", 4))


# projection, checks, links


@query(sql("select p.id, s.code, p.x + s.dx as x, p.y + s.dy as y from poi p, (values (1, 0, 0), (2, 0, 20), (3, 0, 40), (4, 20, 0), (5, 40, 0), (6, 0, -20), (7, 0, -40), (8, -20, 0), (9, -40, 0)) s(code, dx, dy)", "poi"))
def sub_points(spark, sf):
    made = X.pois(spark, sf).select("id", F.explode(P.sub_points(c("x"), c("y"), P.cross_offsets(20, 2))).alias("s"))
    return made.select("id", "s.code", "s.x", "s.y")


@query(sql("select id, 0::bigint as error_mm from poi", "poi"))
def laea_roundtrip(spark, sf):
    lat, lon = P.from_laea(c("x"), c("y"))
    east, north = P.to_laea(c("lat"), c("lon"))
    made = X.pois(spark, sf).select("id", "x", "y", lat.alias("lat"), lon.alias("lon"))
    return made.select("id", F.round(F.hypot(east - c("x"), north - c("y")) * 1000).cast("long").alias("error_mm"))


@query()
def tessellation_issues(spark, sf):
    boxes = keep(X.buildings(spark, sf).repartition(tasks(spark)), "boxes")
    polygons = boxes.select("id", F.array(G.box_ring(c("xmin"), c("ymin"), c("xmax"), c("ymax"))).alias("rings"))
    return tessellation.all_issues([tessellation.overlaps(boxes, 250.0), tessellation.micro_segments(polygons, 25.0), tessellation.noding(polygons, 250.0, 5.0), tessellation.self_crossings(polygons, 250.0), tessellation.thin_boxes(boxes, 12.0), tessellation.slivers(polygons, 6.0)])


@query("select page_id, href, case when regexp_extract(regexp_replace(href, '[?#].*$', ''), '([^/]*)$', 1) = '' then 'default_download' else regexp_extract(regexp_replace(href, '[?#].*$', ''), '([^/]*)$', 1) end as file_name from (select page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) as href from pages)")
def html_links(spark, sf):
    return readers.links(table(spark, sf, "pages")).select("page_id", "href", "file_name")


@query("select date_trunc('day', ts) as day, user_id // 50 * 50 as x, 0::bigint as y, count(*) as n from events group by all")
def event_windows(spark, sf):
    from gridloom.streaming import windowed_cells

    rows = table(spark, sf, "events").select("ts", c("user_id").alias("x"), F.lit(0).alias("y"))
    return windowed_cells(rows, 50, "1 day", "1 day", {"n": F.count("*")}).select(c("window.start").alias("day"), "x", "y", "n")


# lines, codes, kernels


@query(sql("select res, x, y, cast(count(*) as bigint) as n from (select unnest([2000, 10000]) as res, px, py from (select x as px, y as py from poi)), lateral (select px // res * res as x, py // res * res as y) group by 1, 2, 3", "poi"))
def poi_counts(spark, sf):
    return grid.point_counts(X.pois(spark, sf), [2000, 10000])


@query(sql("select distinct code, dense_rank() over (order by code)::bigint as number from pop", "pop"))
def dense_codes(spark, sf):
    return grid.dense_codes(X.pop_cells(spark, sf), "code", "number")


@query(sql("select id as b, x::double as x, y::double as y from (select b.id, unnest(range(3000000, 3040001, 2000)) as y, xmin, ymin, xmax, ymax from buildings b) t, (values (0)) u(z), lateral (select unnest([xmin, xmax]) as x) where y between ymin and ymax group by all", "buildings"))
def line_crossings(spark, sf):
    lines = spark.range(0, 21).select(c("id"), F.array(F.array(F.lit(3999000.0), (3000000 + c("id") * 2000).cast("double")), F.array(F.lit(4061000.0), (3000000 + c("id") * 2000).cast("double"))).alias("line"))
    rings = X.buildings(spark, sf).select("id", G.box_ring(c("xmin"), c("ymin"), c("xmax"), c("ymax")).alias("line"))
    from gridloom.operators.lines import crossings

    return crossings(lines, rings, 500.0).select("b", "x", "y")


@query(sql(f"{_LABELS} select a, b, cost from (select node as a, (node * 13 + 5) % (select count(*) from customer) as b from sources) p left join (select source, node, cost from sp where cost <= 40) s on s.source = p.a and s.node = p.b", "edges", "sources", recursive=True))
def pair_costs(spark, sf):
    n = table(spark, sf, "customer").count()
    pairs = X.sources(spark, sf).selectExpr("node as a", f"(node * 13 + 5) % {n} as b")
    return paths.pair_costs(X.edges(spark, sf), pairs, 40)


@query("select p_partkey as id, 3 as points, 0.0::double as off from part where p_size > 0")
def line_simplify(spark, sf):
    from gridloom.functions import kernels

    made = table(spark, sf, "part").where("p_size > 0").select(c("p_partkey").alias("id"), F.expr(_LINE).alias("line"))
    made = made.withColumn("dense", G.densify(c("line"), 20.0))
    thin = kernels.simplify(0.5)(c("dense"))
    return made.select("id", F.size(thin).alias("points"), kernels.hausdorff(thin, c("line")).alias("off"))


@query(sql("select id, round((xmin + xmax) / 2.0::double, 4) as x, round((ymin + ymax) / 2.0::double, 4) as y from buildings", "buildings"))
def hull_centres(spark, sf):
    from gridloom.functions import kernels

    made = X.buildings(spark, sf).select("id", kernels.hull_centre(G.box_ring(c("xmin") - 4000000, c("ymin") - 3000000, c("xmax") - 4000000, c("ymax") - 3000000)).alias("p"))
    return made.select("id", (F.round(c("p")[0], 4) + 4000000).alias("x"), (F.round(c("p")[1], 4) + 3000000).alias("y"))


@query(sql("select id, least(pop * 10, 32767)::bigint as value from pop", "pop"))
def saturate(spark, sf):
    return X.pop_cells(spark, sf).select("id", C.saturate_short(c("pop") * 10).alias("value"))


@query("select tx, ty from (select t.tx, u.ty from (select unnest(range(0, 6)) as tx) t, (select unnest(range(0, 4)) as ty) u) where (tx + ty) % 3 > 0")
def tiles_left_to_do(spark, sf):
    from gridloom.sources.writers import missing_tiles

    plan = spark.range(0, 6).select(c("id").alias("tx"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long"))).alias("ty"))
    return missing_tiles(plan, plan.where("(tx + ty) % 3 = 0"))
