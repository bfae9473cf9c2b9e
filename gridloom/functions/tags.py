"""Key-value tag text (``"k"=>"v","k2"=>"v2"``) and what is read from it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Speeds in km/h by road class.
ROAD_CLASS_KMH = {
    "motorway": 110,
    "motorway_link": 80,
    "trunk": 80,
    "trunk_link": 60,
    "primary": 80,
    "primary_link": 60,
    "secondary": 70,
    "secondary_link": 50,
    "tertiary": 50,
    "tertiary_link": 40,
    "residential": 30,
    "unclassified": 30,
    "living_street": 30,
    "service": 30,
    "pedestrian": 5,
    "footway": 5,
    "bridleway": 5,
    "steps": 5,
    "corridor": 5,
    "path": 5,
    "via_ferrata": 5,
    "track": 10,
    "cycleway": 10,
    "construction": 10,
    "proposed": 10,
}
OTHER_KMH = 30


def tag_map(tags: Column) -> Column:
    """Map of the tags; of equal keys the last counts. Null text gives null, malformed entries are left out."""
    entries = F.split(F.regexp_replace(tags, r'^\s*"|"\s*$', ""), r'",\s*"')
    pairs = F.transform(entries, lambda e: F.split(e, r'"\s*=>\s*"'))
    proper = F.filter(pairs, lambda p: F.size(p) == 2)
    later = F.filter(proper, lambda p, i: ~F.exists(F.slice(proper, i + 2, F.size(proper)), lambda q: q[0] == p[0]))
    return F.map_from_entries(F.transform(later, lambda p: F.struct(p[0], p[1])))


def tag(tags: Column, key: str) -> Column:
    return F.try_element_at(tag_map(tags), F.lit(key))


def with_tags(df, tags_col: str, keys: list[str]):
    """df with a column for each key; null where the key is absent."""
    held = tag_map(F.col(tags_col))
    return df.withColumns({k: F.try_element_at(held, F.lit(k)) for k in keys})


def road_class_kmh(road_class: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in ROAD_CLASS_KMH.items() for x in kv])
    return F.coalesce(F.try_element_at(table, road_class), F.lit(OTHER_KMH))


def floors_from_tags(tags: Column) -> Column:
    """Floors: building:levels, else height / 3, else levels, else 1. The first tag present decides; unreadable is 1."""
    first, height, plain = tag(tags, "building:levels"), tag(tags, "height"), tag(tags, "levels")
    metres = F.replace(F.replace(height, F.lit(","), F.lit(".")), F.lit("~"), F.lit("")).try_cast("double")
    return F.coalesce(F.when(first.isNotNull(), first.try_cast("double")).when(height.isNotNull(), metres / 3).when(plain.isNotNull(), plain.try_cast("double")), F.lit(1.0))


def construction_date(tags: Column) -> Column:
    return F.coalesce(tag(tags, "construction_date"), tag(tags, "start_date"))
