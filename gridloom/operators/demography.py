"""Buildings and people: harmonised attributes, area-weighted grids, synthetic people, dasymetric mapping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.functions.cells import half_even, snap
from gridloom.operators.grid import cells_of_box
from gridloom.operators.spatial import overlay_cells

# Uses of buildings by source.
FR_ACTIVITY = ("Agricole", "Commercial et services", "Industriel")
FR_CULTURAL_NATURE = ("Tour, donjon", "Monument", "Moulin à vent", "Arc de triomphe", "Fort, blockhaus, casemate", "Eglise", "Château", "Chapelle", "Arène ou théâtre antique")
NL_RESIDENTIAL = ("woonfunctie", "logiesfunctie")
NL_ACTIVITY = ("overige gebruiksfunctie", "industriefunctie", "kantoorfunctie", "sportfunctie", "winkelfunctie", "gezondheidszorgfunctie", "bijeenkomstfunctie", "onderwijsfunctie", "celfunctie")
NL_CULTURAL = ("windmolen: korenmolen", "kerk", "kasteel", "kapel", "bunker", "vuurtoren", "toren", "windmolen: watermolen", "windmolen", "klooster, abdij", "moskee", "fort", "waterradmolen", "paleis", "overig religieus gebouw", "klokkentoren", "koepel", "synagoge")
PL_RESIDENTIAL = ("budynkiMieszkalneJednorodzinne", "budynkiODwochMieszkaniach", "budynkiOTrzechIWiecejMieszkaniach", "budynkiZbiorowegoZamieszkania")
PL_ACTIVITY = ("budynekGospodarstwaRolnego", "budynkiBiurowe", "budynkiHandlowoUslugowe", "budynkiHoteli", "budynkiKulturyFizycznej", "budynkiLacznosciDworcowITerminali", "budynkiMuzeowIBibliotek", "budynkiPrzemyslowe", "budynkiSzkolIInstytucjiBadawczych", "budynkiSzpitaliIZakladowOpiekiMedycznej", "budynkiZakwaterowaniaTurystycznegoPozostale", "ogolnodostepneObiektyKulturalne", "pozostaleBudynkiNiemieszkalne", "zbiornikSilosIBudynkiMagazynowe")
PL_CULTURAL = ("budynekZabytkowy", "budynkiKultuReligijnego")
IT_ACTIVITY = ("02", "03", "04", "06", "07", "08", "09", "10", "11", "12")
IT_CULTURAL_TYPE = ("03", "06", "07", "10", "11", "12", "13", "15", "16", "17", "18", "20", "22", "24", "25")
LU_CULTURAL = (41004, 41005, 41302, 41303, 41305)


def floors(height: Column, low: float | None = 0, high: float | None = 300, outside: float = 1.0, at_least_one: bool = True) -> Column:
    """ceil(height / 3); a height outside [low, high] counts as ``outside`` metres, a missing one is 1 floor."""
    h = height.cast("double")
    known = h.isNotNull() & ~F.isnan(h)
    if low is not None:
        h = F.when(h.between(low, high), h).otherwise(F.lit(outside))
    n = F.ceil(h / 3)
    return F.when(known, F.greatest(n, F.lit(1)) if at_least_one else n).otherwise(F.lit(1)).cast("long")


def _sure(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def share_of(tokens: Column, values) -> Column:
    """Share of the tokens that are among the values; 0 without tokens."""
    hits = F.size(F.filter(tokens, lambda t: t.isin(*values)))
    return F.when(F.size(tokens) > 0, hits / F.size(tokens)).otherwise(F.lit(0.0))


def harmonise(df: DataFrame, source: str, *, small: Column | None = None, nl_activity: tuple = NL_ACTIVITY, nl_cultural: tuple = NL_CULTURAL, pl_residential: tuple = PL_RESIDENTIAL, pl_activity: tuple = PL_ACTIVITY, pl_cultural: tuple = PL_CULTURAL) -> DataFrame:
    """df with floor_nb, residential, activity, cultural_value (shares from 0 to 1) by the rules of its source.

    small: whether shrinking the building by 25 m leaves nothing (sources at and cz). The lists of uses of
    nl and pl may be replaced by others.
    """
    c = F.col
    when = lambda *rules: reduce(lambda w, r: w.when(_sure(r[0]), float(r[1])), rules[1:], F.when(_sure(rules[0][0]), float(rules[0][1]))).otherwise(0.0)
    if source == "fr":
        made = (
            floors(c("hauteur"), None, None, at_least_one=False),
            when((c("usage_1") == "Résidentiel", 1), (c("usage_2") == "Résidentiel", 0.3), (c("usage_1") == "Indifférencié", 0.25)),
            when((c("usage_1").isin(*FR_ACTIVITY), 1), (c("usage_2").isin(*FR_ACTIVITY), 0.3), (c("usage_1") == "Indifférencié", 0.25)),
            when(((c("usage_1") == "Religieux") | c("nature").isin(*FR_CULTURAL_NATURE), 1)),
        )
    elif source == "lu":
        n = F.coalesce(c("NATURE").cast("int"), F.lit(0))
        z, ground = c("mean_z"), c("dtm")
        odd = _sure(ground == -32767) | _sure((z > 1000) | (z < 0)) | _sure((ground < 0) | (ground > 700))
        h = F.when(odd, 3.0).otherwise(z - ground)
        h = F.when(h > 120, 3.0).otherwise(h)
        made = (floors(h, None, None), when((n == 0, 1)), when((((n >= 10000) & (n < 42000)) | (n == 80000), 1)), when((n.isin(*LU_CULTURAL) | n.between(50000, 50011), 1)))
    elif source == "nl":
        uses = F.split(F.coalesce(c("gebruiksdoel"), F.lit("")), ",")
        count = lambda values: F.size(F.filter(uses, lambda t: t.isin(*values)))
        res, act = count(NL_RESIDENTIAL), count(nl_activity) if nl_activity else F.lit(0)
        both = res + act
        share = lambda n: F.when(both > 0, n / both).otherwise(0.0)
        kinds = F.split(F.coalesce(c("top10nl_typegebouw"), F.lit("")), r"\|")
        made = (floors(c("3dbag_b3_height_lod12"), 0, 250), share(res), share(act), share_of(kinds, nl_cultural) if nl_cultural else F.lit(0.0))
    elif source == "pl":
        use = c("FUNOGBUD")
        cult = _sure(c("ZABYTEK") == "Tak") | (_sure(use.isin(*pl_cultural)) if pl_cultural else F.lit(False))
        made = (F.coalesce(c("LKOND").cast("long"), F.lit(1)), when((use.isin(*pl_residential), 1)) if pl_residential else F.lit(0.0), when((use.isin(*pl_activity), 1)) if pl_activity else F.lit(0.0), when((cult, 1)))
    elif source == "it":
        use, kind, monument = (F.substring(c(n), 1, 2) for n in ("edifc_uso", "edifc_ty", "edifc_mon"))
        made = (F.lit(1).cast("long"), when((use == "01", 1), (use == "93", 0.25)), when((use.isin(*IT_ACTIVITY), 1), (use == "93", 0.25)), when(((use == "05") | (monument == "01") | kind.isin(*IT_CULTURAL_TYPE), 1)))
    elif source in ("at", "cz"):
        home = _sure(small if small is not None else F.lit(True))
        made = (floors(c("HOEHE_OBJEKT_MAX")) if source == "at" else F.lit(1).cast("long"), F.when(home, 1.0).otherwise(0.0), F.when(home, 0.0).otherwise(1.0), F.lit(0.0))
    else:
        raise ValueError(f"no rules for buildings of {source}")
    return df.withColumns(dict(zip(("floor_nb", "residential", "activity", "cultural_value"), made, strict=True)))


def _hundredths(billionths: Column) -> Column:
    """Billionths rounded half to even to two places."""
    whole, rest = F.floor(billionths / 10_000_000).cast("long"), billionths % 10_000_000
    up = (rest > 5_000_000) | ((rest == 5_000_000) & (whole % 2 == 1))
    return (whole + up.cast("long")) / 100


def building_grid(buildings: DataFrame, res: int) -> DataFrame:
    """Cells with the number, ground and floor area of buildings (boxes), in all and by use, by the area in the cell."""
    parts = overlay_cells(buildings, res)
    whole = (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))
    floor = F.col("area") * F.col("floor_nb")
    billionths = F.floor(F.least(F.col("area") / whole, F.lit(1.0)) * 1e9 + 0.5).cast("long")  # whole numbers add up alike in any order
    aggs = {"number": _hundredths(F.sum(billionths)), "ground_area": half_even(F.sum("area")), "floor_area": half_even(F.sum(floor))}
    for name, use in (("residential", "residential"), ("economic_activity", "activity"), ("cultural", "cultural_value")):
        aggs[f"{name}_ground_area"] = half_even(F.sum(F.col("area") * F.col(use)))
        aggs[f"{name}_floor_area"] = half_even(F.sum(floor * F.col(use)))
    return parts.groupBy(F.col("cx").alias("x"), F.col("cy").alias("y")).agg(*[a.cast("double").alias(n) for n, a in aggs.items()])


def synthetic_people(units: DataFrame, unit: str, total: str, structure: dict[str, list[str]], seed: int = 0) -> DataFrame:
    """(unit, person, a column for each category): people whose marginals equal the counts of each mode.

    Every category is a random order of its labels of its own, fixed by the seed; labels short of the total are null.
    """
    people = units.where(F.col(total) > 0).select(unit, F.explode(F.sequence(F.lit(1).cast("long"), F.col(total).cast("long"))).alias("person"))
    for category, modes in structure.items():
        labels = F.flatten(F.array(*[F.array_repeat(F.lit(m), F.greatest(F.coalesce(F.col(m), F.lit(0)), F.lit(0)).cast("int")) for m in modes]))
        held = units.where(F.col(total) > 0).select(unit, F.posexplode(labels).alias("place", category))
        turn = F.row_number().over(Window.partitionBy(unit).orderBy(F.xxhash64(F.lit(seed), F.lit(category), F.col(unit), F.col("place")), "place"))
        people = people.join(held.select(unit, category, turn.cast("long").alias("person")), [unit, "person"], "left")
    return people


def people_statistics(people: DataFrame, keys: list[str], structure: dict[str, list[str]]) -> DataFrame:
    """Counts of people in all (total) and by mode."""
    return people.groupBy(*keys).agg(F.count("*").alias("total"), *[F.count_if(F.col(c) == m).alias(m) for c, modes in structure.items() for m in modes])


def place_people(people: DataFrame, areas: DataFrame, unit: str, total: str, threshold: int = 0, seed: int = 0) -> DataFrame:
    """People with a place (px, py): the middle of the unit where it has at most ``threshold`` people, else evenly in its target boxes.

    areas: boxes (unit, xmin, ymin, xmax, ymax, and total) that do not overlap, one or several to a unit; places are
    fixed by the seed. Each person of a unit with a box gets one place; boxes without an area are left out.
    """
    size = (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))
    held = Window.partitionBy(unit)
    order = held.orderBy("xmin", "ymin", "xmax", "ymax")
    boxes = areas.select(unit, total, "xmin", "ymin", "xmax", "ymax").where(size > 0)
    until = F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0))
    spans = boxes.select("*", until.alias("hi"), F.row_number().over(order).alias("__n"), F.count("*").over(held).alias("__of"), *[f(c).over(held).alias(f"u{c}") for f, c in ((F.min, "xmin"), (F.min, "ymin"), (F.max, "xmax"), (F.max, "ymax"))])
    # each box begins where the one before it ends, the last one is open, so that a person meets one box exactly
    spans = spans.withColumns({"lo": F.coalesce(F.lag("hi").over(order), F.lit(0.0)), "whole": F.max("hi").over(held)})
    spans = spans.withColumn("hi", F.when(F.col("__n") == F.col("__of"), F.lit(float("inf"))).otherwise(F.col("hi"))).drop("__n", "__of")
    chance = lambda k: F.pmod(F.xxhash64(F.lit(seed), F.lit(k), F.col(unit), F.col("person")), F.lit(1 << 30)) / float(1 << 30)
    drawn = people.withColumns({"r0": chance(0), "r1": chance(1), "r2": chance(2)})
    pick = F.col("r0") * F.col("whole")
    met = drawn.join(spans, unit).where((pick >= F.col("lo")) & (pick < F.col("hi")))
    few = F.col(total) <= threshold
    px = F.when(few, (F.col("uxmin") + F.col("uxmax")) / 2).otherwise(F.col("xmin") + F.col("r1") * (F.col("xmax") - F.col("xmin")))
    py = F.when(few, (F.col("uymin") + F.col("uymax")) / 2).otherwise(F.col("ymin") + F.col("r2") * (F.col("ymax") - F.col("ymin")))
    return met.select(*people.columns, px.alias("px"), py.alias("py"))


def disjoint(boxes: DataFrame, keys: list[str]) -> DataFrame:
    """The union of the boxes of each key as boxes that do not overlap: strips between neighbouring x edges, with y spans merged."""
    held = Window.partitionBy(*keys).orderBy("x0")
    edges = boxes.select(*keys, F.explode(F.array("xmin", "xmax")).alias("x0")).distinct().withColumn("x1", F.lead("x0").over(held)).where("x1 is not null")
    named = {k: f"__{k}" for k in keys}
    met = edges.withColumnsRenamed(named)
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in named.items()]
    strips = boxes.join(met, [*same, (F.col("xmin") <= F.col("x0")) & (F.col("x1") <= F.col("xmax"))]).select(*keys, "x0", "x1", "ymin", "ymax")
    before = Window.partitionBy(*keys, "x0").orderBy("ymin", "ymax")
    run = F.max("ymax").over(before.rowsBetween(Window.unboundedPreceding, -1))
    new = strips.withColumn("new", F.when(F.col("ymin") <= run, 0).otherwise(1))
    runs = new.withColumn("run", F.sum("new").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*keys, "x0", "x1", "run").agg(F.min("ymin").alias("ymin"), F.max("ymax").alias("ymax")).select(*keys, F.col("x0").alias("xmin"), "ymin", F.col("x1").alias("xmax"), "ymax")


def dasymetric_targets(units: DataFrame, candidates: DataFrame, size: float, unit: str = "unit") -> DataFrame:
    """Unit boxes cut to the union of the candidate boxes they overlap (in parts that do not overlap); the whole unit without any."""
    from gridloom.operators.spatial import spread

    a = spread(units, size)
    b = spread(candidates.select(*[F.col(c).alias(f"c{c}") for c in ("xmin", "ymin", "xmax", "ymax")]).withColumnsRenamed({"cxmin": "xmin", "cymin": "ymin", "cxmax": "xmax", "cymax": "ymax"}), size).withColumnsRenamed({"xmin": "cxmin", "ymin": "cymin", "xmax": "cxmax", "ymax": "cymax"})
    x1, y1, x2, y2 = F.greatest("xmin", "cxmin"), F.greatest("ymin", "cymin"), F.least("xmax", "cxmax"), F.least("ymax", "cymax")
    first = (F.col("bx") == F.floor(x1 / size)) & (F.col("by") == F.floor(y1 / size))
    rest = [c for c in units.columns if c not in ("xmin", "ymin", "xmax", "ymax")]
    parts = a.join(b, ["bx", "by"]).where((x1 < x2) & (y1 < y2) & first).select(*rest, x1.alias("xmin"), y1.alias("ymin"), x2.alias("xmax"), y2.alias("ymax")).distinct()
    parts = disjoint(parts, rest)
    whole = units.join(parts.select(unit).distinct(), unit, "left_anti")
    return parts.unionByName(whole.select(*parts.columns))


def to_grid_by_area(areas: DataFrame, res: int, values: list[str]) -> DataFrame:
    """Values (over 0) of boxes shared out to cells by area; cells without any are left out."""
    whole = (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))
    parts = overlay_cells(areas, res)
    sums = parts.groupBy(F.col("cx").alias("x"), F.col("cy").alias("y")).agg(*[F.sum(F.when(F.col(v) > 0, F.col(v) * F.col("area") / whole)).alias(v) for v in values])
    return sums.where(reduce(lambda a, b: a | b, [F.coalesce(F.col(v), F.lit(0)) > 0 for v in values]))


def to_grid_by_point(points: DataFrame, res: int, values: list[str], x: str = "x", y: str = "y") -> DataFrame:
    """Values (over 0) of points summed by the cell they lie in (half-open)."""
    sums = points.groupBy(snap(F.col(x), res).alias("x"), snap(F.col(y), res).alias("y")).agg(*[F.sum(F.when(F.col(v) > 0, F.col(v))).alias(v) for v in values])
    return sums.where(reduce(lambda a, b: a | b, [F.coalesce(F.col(v), F.lit(0)) > 0 for v in values]))


def people_to_grid(people: DataFrame, res: int, structure: dict[str, list[str]]) -> DataFrame:
    cells = people.withColumns({"x": snap(F.col("px"), res), "y": snap(F.col("py"), res)})
    return people_statistics(cells, ["x", "y"], structure)


def covered_cells(boxes: DataFrame, res: int) -> DataFrame:
    return cells_of_box(boxes, res)


def use_shares(use: Column, residential: tuple, activity: tuple, both: tuple = ()) -> dict[str, Column]:
    """Shares by a single use: all of it, or 0.7 and 0.3 where a use serves both; 0.1 each where it is unknown."""
    of = lambda mine: F.when(_sure(use.isin(*mine)), 1.0)
    mixed = _sure(use.isin(*both)) if both else F.lit(False)
    return {
        "residential": of(residential).when(mixed, 0.7).when(use.isNull(), 0.1).otherwise(0.0),
        "activity": of(activity).when(mixed, 0.3).when(use.isNull(), 0.1).otherwise(0.0),
    }
