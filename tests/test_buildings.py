"""Harmonised buildings: a row for each source by its own rules, with the lists of uses that hold by default."""

from pyspark.sql import functions as F

from gridloom.operators import demography

ROWS = {
    "nl": [
        ("`3dbag_b3_height_lod12` double, gebruiksdoel string, top10nl_typegebouw string", (9.5, "woonfunctie,winkelfunctie", "kerk|overig"), (4, 0.5, 0.5, 0.5)),
        ("`3dbag_b3_height_lod12` double, gebruiksdoel string, top10nl_typegebouw string", (None, "celfunctie", "klooster, abdij"), (1, 0.0, 1.0, 1.0)),
    ],
    "pl": [
        ("LKOND int, ZABYTEK string, FUNOGBUD string", (3, "Nie", "budynkiODwochMieszkaniach"), (3, 1.0, 0.0, 0.0)),
        ("LKOND int, ZABYTEK string, FUNOGBUD string", (None, "Tak", "budynkiBiurowe"), (1, 0.0, 1.0, 1.0)),
        ("LKOND int, ZABYTEK string, FUNOGBUD string", (2, None, "budynkiKultuReligijnego"), (2, 0.0, 0.0, 1.0)),
    ],
    "it": [("edifc_uso string, edifc_ty string, edifc_mon string", ("9301", "0300", "02"), (1, 0.25, 0.25, 1.0))],
    "lu": [("NATURE string, mean_z double, dtm double", ("41004", 310.0, 300.0), (4, 0.0, 1.0, 1.0))],
    "fr": [("hauteur double, usage_1 string, usage_2 string, nature string", (7.0, "Agricole", "Résidentiel", "Moulin à vent"), (3, 0.3, 1.0, 1.0))],
    "at": [("HOEHE_OBJEKT_MAX double", (301.0,), (1, 1.0, 0.0, 0.0))],
    "cz": [("id int", (1,), (1, 1.0, 0.0, 0.0))],
}


def test_each_source(spark):
    for source, cases in ROWS.items():
        for schema, row, held in cases:
            made = demography.harmonise(spark.createDataFrame([row], schema), source, small=F.lit(True))
            assert tuple(made.select("floor_nb", "residential", "activity", "cultural_value").first()) == held, source


def test_lists_of_uses_are_whole(spark):
    for use, kinds, name in (("gebruiksdoel", demography.NL_RESIDENTIAL, "residential"), ("gebruiksdoel", demography.NL_ACTIVITY, "activity"), ("top10nl_typegebouw", demography.NL_CULTURAL, "cultural_value")):
        rows = spark.createDataFrame([(k,) for k in kinds], "k string").select(F.lit(3.0).alias("3dbag_b3_height_lod12"), *[(F.col("k") if use == n else F.lit(None).cast("string")).alias(n) for n in ("gebruiksdoel", "top10nl_typegebouw")])
        assert [r[0] for r in demography.harmonise(rows, "nl").select(name).collect()] == [1.0] * len(kinds)
    for kinds, name in ((demography.PL_RESIDENTIAL, "residential"), (demography.PL_ACTIVITY, "activity"), (demography.PL_CULTURAL, "cultural_value")):
        rows = spark.createDataFrame([(1, "Nie", k) for k in kinds], "LKOND int, ZABYTEK string, FUNOGBUD string")
        assert [r[0] for r in demography.harmonise(rows, "pl").select(name).collect()] == [1.0] * len(kinds)
    assert [len(v) for v in (demography.NL_ACTIVITY, demography.NL_CULTURAL, demography.PL_RESIDENTIAL, demography.PL_ACTIVITY, demography.PL_CULTURAL)] == [9, 18, 4, 14, 2]
