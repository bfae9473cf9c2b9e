import pytest
from pyspark.sql import functions as F

from gridloom.functions import cells as C
from gridloom.functions import census as S
from gridloom.functions import classify as K
from gridloom.functions import geometry as G
from gridloom.functions import projection as P
from gridloom.functions import roads as R
from gridloom.functions import tags as T


def one(spark, *cols):
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).collect()[0]
    return row[0] if len(cols) == 1 else tuple(row)


def test_cell_ids(spark):
    held = F.lit("CRS3035RES100mN2953200E4041600")
    assert one(spark, *[C.cell_part(held, p) for p in ("crs", "res", "x", "y")]) == (3035, 100, 4041600, 2953200)
    assert one(spark, C.cell_id(F.lit(4041600.9), F.lit(-5), 100)) == "CRS3035RES100mN-5E4041600"
    assert one(spark, C.cell_part(F.lit("CRS3035"), "x")) is None
    assert one(spark, C.iceland_cell_id(F.lit("1kmN500E600"))) == "CRS9947RES1000mN500000E600000"
    assert one(spark, C.snap(F.lit(-1), 1000), C.snap_up(F.lit(1), 1000)) == (-1000, 1000)
    assert one(spark, C.half_even(F.lit(2.5)), C.half_even(F.lit(1235), -1)) == (2.0, 1240)
    assert one(spark, *C.pixel_index(F.lit(0), F.lit(2000), 0, 3000, 1000)) == (0, 0)


@pytest.mark.parametrize(("values", "expected"), [(["3", "-1", "0", "4"], 7), (["-1", "-1"], -1), (["0", "0"], 0), (["5", ""], None), (["0", "-1"], -1)])
def test_confidential_sums(spark, values, expected):
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    assert rows.agg(S.confidential_sum(F.col("v"))).collect()[0][0] == expected


def test_confidential_sum_of_nothing(spark):
    assert spark.createDataFrame([], "v string").agg(S.confidential_sum(F.col("v"))).collect()[0][0] == 0


@pytest.mark.parametrize(("v", "ci", "expected"), [("-9999", "-9999", "-1"), ("12", "-9999", "12"), ("12", "0", "12"), ("-9999", "", "-1"), ("5", "-9986", "-1"), ("", "", "")])
def test_confidential_values(spark, v, ci, expected):
    assert one(spark, S.confidential_value(F.lit(v), F.lit(ci))) == expected


CENSUS = [
    ("none", 10, 6, 4, None, 1, ""),
    ("sum", 10, 6, 5, None, 1, "SEX_sum_T=10_SUM=11"),
    ("hidden", 10, -9999, 4, -9999, 1, ""),
    ("empty", 0, 0, 0, None, 1, "POPULATED_T_inconsistency_POPULATED=1_T=0"),
    ("flag", 10, 6, 4, 7, 1, "M_CI_value=7,M_CI_inconsistency_ci=7_value=6"),
    ("null", 10, None, 10, None, 1, "M_none_value=None"),
    ("negative", 10, -3, 13, None, 1, "M_negative_value=-3"),
    ("short", 10, 6, 3, None, 1, "SEX_sum_T=10_SUM=9"),
]


def test_census_rules(spark):
    rows = spark.createDataFrame([r[:6] for r in CENSUS], "GRD_ID string, T long, M long, F long, M_CI long, POPULATED long").withColumn("F_CI", F.lit(None).cast("long"))
    found = {r["GRD_ID"]: r["errors"] for r in S.validate(rows).collect()}
    assert found == {r[0]: r[6] for r in CENSUS if r[6]}
    reading = {r["GRD_ID"]: r["errors"] for r in S.validate(rows, all_flags_needed=True).collect()}
    assert "short" not in reading
    assert {r["rule"] for r in S.validate_each(rows).collect()} == {"cat_sum_sex", "populated_consis", "ci_val", "ci_consis", "pop_values_none", "pop_values_non_neg"}


def test_pivot_raises_on_two_values(spark):
    rows = spark.createDataFrame([("a", "T", 1), ("a", "M", 2), ("b", "T", 3)], "SPATIAL string, STAT string, OBS_VALUE long")
    assert sorted(map(tuple, S.pivot_statistics(rows, names=["T", "M"]).collect())) == [("a", 1, 2), ("b", 3, None)]
    with pytest.raises(Exception, match="two values"):
        S.pivot_statistics(rows.union(rows.limit(1)), names=["T", "M"]).collect()


def test_travel_times(spark):
    def times(fow, pos, neg, kph, metres, feature=4110):
        w = R.travel_times(*[F.lit(v).cast("double") if v is not None else F.lit(None).cast("double") for v in (fow, feature, pos, neg, kph, metres)])
        return tuple(one(spark, w))

    assert times(3, 72, None, None, 1000) == (50.0, None)
    assert times(3, None, None, 0, 100) == (36.0, 36.0)
    assert times(19, 50, 50, 50, 100) == times(20, 50, 50, 50, 100) == (None, None)
    assert times(14, 50, 50, 50, 100) == (36.0, 36.0)
    assert times(-1, None, None, None, 100, 4130) == (18.0, 18.0)


@pytest.mark.parametrize(("text", "expected"), [('"a"=>"b","building:levels"=>"4"', 4.0), ('"building:levels"=>"4"', 4.0), ('"a"=>"b","height"=>"~9,0"', 3.0), ('"a"=>"b","building:levels"=>"x"', 1.0), ('"levels"=>"2"', 2.0), ("broken", 1.0), (None, 1.0)])
def test_floors_from_tags(spark, text, expected):
    assert one(spark, T.floors_from_tags(F.lit(text).cast("string"))) == expected


def test_tags(spark):
    held = T.tag_map(F.lit('"a"=>"1","b"=>"x, y","a"=>"2"'))
    assert one(spark, held) == {"a": "2", "b": "x, y"}
    assert one(spark, T.road_class_kmh(F.lit("motorway")), T.road_class_kmh(F.lit("odd")), T.road_class_kmh(F.lit(None).cast("string"))) == (110, 30, 30)


def test_geometry(spark):
    line = lambda *p: F.array(*[F.array(F.lit(float(x)), F.lit(float(y))) for x, y in p])
    assert [round(p[1], 2) for p in one(spark, G.densify(line((0, 0), (0, 250)), 100))] == [0, 83.33, 166.67, 250]
    assert one(spark, G.densify(line((0, 0), (0, 50)), 100)) == [[0, 0], [0, 50]]
    five = line((0, 0), (1, 0), (2, 0), (3, 0), (4, 0))
    assert one(spark, G.chunks(five, 2)) == [[[0, 0], [1, 0]], [[2, 0], [3, 0]]]
    assert one(spark, G.line_length(five), F.size(G.segments(five))) == (4.0, 4)
    square = line((0, 0), (4, 0), (4, 4), (0, 4), (0, 0))
    hole = line((1, 1), (2, 1), (2, 2), (1, 2), (1, 1))
    assert one(spark, G.polygon_area(F.array(square, hole))) == 15.0
    assert one(spark, G.ring_centroid(square)) == [2.0, 2.0]
    inside = lambda x, y: one(spark, G.point_in_polygon(F.lit(x), F.lit(y), F.array(square, hole)))
    assert inside(3.0, 3.0) and not inside(1.5, 1.5) and not inside(5.0, 1.0)
    seg = lambda *p: line(*p)
    assert one(spark, G.segment_crossing(seg((0, 0), (2, 2)), seg((0, 2), (2, 0)))) == [1.0, 1.0]
    assert one(spark, G.segment_crossing(seg((0, 0), (1, 0)), seg((0, 1), (1, 1)))) is None
    assert one(spark, G.segment_distance(F.lit(0.0), F.lit(3.0), seg((-1, 0), (1, 0)))) == 3.0
    triangle = line((0, 0), (4, 0), (0, 4), (0, 0))
    assert one(spark, F.abs(G.ring_area(G.clip_ring(triangle, F.lit(0.0), F.lit(0.0), F.lit(2.0), F.lit(2.0))))) == 4.0
    assert one(spark, F.abs(G.ring_area(G.clip_ring(triangle, F.lit(2.0), F.lit(2.0), F.lit(4.0), F.lit(4.0))))) == 0.0
    assert one(spark, G.mean_z(F.array(F.array(F.lit(0.0), F.lit(0.0), F.lit(3.0)), F.array(F.lit(0.0), F.lit(0.0), F.lit(5.0))))) == 4.0


def test_projection(spark):
    east, north = one(spark, *P.to_laea(F.lit(50.0), F.lit(5.0)))
    assert (east, north) == pytest.approx((3962799.451, 2999718.853), abs=1e-3)
    lat, lon = one(spark, *P.from_laea(F.lit(east), F.lit(north)))
    assert (lat, lon) == pytest.approx((50.0, 5.0), abs=1e-10)
    assert one(spark, *P.from_laea(F.lit(4321000.0), F.lit(3210000.0))) == pytest.approx((52.0, 10.0), abs=1e-10)


def test_trivariate(spark):
    cls = lambda a, b, d, **k: one(spark, K.trivariate_class([F.lit(a), F.lit(b), F.lit(d)], **k))
    assert cls(0, 0, 0) is None
    assert cls(1, 0, 0) == "0" and cls(0, 1, 0) == "1" and cls(0, 0, 1) == "2"
    assert cls(0, 5, 5) == "m0" and cls(5, 0, 5) == "m1" and cls(5, 5, 0) == "m2"
    assert cls(34, 33, 33, coefficient=0.25) == "center"
    assert cls(1, 0, 0, coefficient=0.25) == "0"
