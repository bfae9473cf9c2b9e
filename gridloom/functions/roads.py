"""Travel costs and usability of road sections.

Codes of the form of way (fow), the feature type and blocked passages are fixed
values of the road data. A direction without a cost is closed (null).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
FERRY_FEATURE = 4130
CLOSED_FOW = (19, 20)
PEDESTRIAN_FOW = (14, 15, 17, 18)
NOT_SNAPPABLE_FOW = (1, 10, 19, 20, 21)
BLOCKED_PASSAGE = (1, 2, 11, 12, 21, 22)
FERRY_KMH, PEDESTRIAN_KMH, FALLBACK_KMH = 20, 10, 10


def seconds(kmh, metres) -> Column:
    """Time to go some metres."""
    m = metres if isinstance(metres, Column) else F.lit(metres)
    k = kmh if isinstance(kmh, Column) else F.lit(kmh)
    return m / k * 3.6


def is_ferry(fow: Column, feature: Column) -> Column:
    return F.coalesce((fow == -1) & (feature == FERRY_FEATURE), F.lit(False))


def travel_times(fow: Column, feature: Column, forward_kmh: Column, backward_kmh: Column, kph: Column, metres: Column) -> Column:
    """Struct(forward, backward) of seconds; null is closed."""
    both = lambda k: F.struct(seconds(k, metres).alias("forward"), seconds(k, metres).alias("backward"))
    nothing = F.lit(None).cast("double")
    fallback = F.when(kph > 0, kph).otherwise(F.lit(FALLBACK_KMH))
    return (
        F.when(is_ferry(fow, feature), both(F.lit(FERRY_KMH)))
        .when(fow.isin(*CLOSED_FOW), F.struct(nothing.alias("forward"), nothing.alias("backward")))
        .when(fow.isin(*PEDESTRIAN_FOW), both(F.lit(PEDESTRIAN_KMH)))
        .when(forward_kmh.isNull() & backward_kmh.isNull(), both(fallback))
        .otherwise(F.struct(seconds(forward_kmh, metres).alias("forward"), seconds(backward_kmh, metres).alias("backward")))
    )


def travel_lengths(fow: Column, feature: Column, forward_kmh: Column, backward_kmh: Column, metres: Column) -> Column:
    """Struct(forward, backward) of metres; null is closed."""
    metres = metres.cast("double")
    nothing = F.lit(None).cast("double")
    both = F.struct(metres.alias("forward"), metres.alias("backward"))
    return (
        F.when(is_ferry(fow, feature) | fow.isin(*PEDESTRIAN_FOW), both)
        .when(fow.isin(*CLOSED_FOW), F.struct(nothing.alias("forward"), nothing.alias("backward")))
        .when(forward_kmh.isNull() & backward_kmh.isNull(), both)
        .otherwise(F.struct(F.when(forward_kmh.isNotNull(), metres).alias("forward"), F.when(backward_kmh.isNotNull(), metres).alias("backward")))
    )


def not_snappable(fow: Column, feature: Column, freeway: Column, from_blocked: Column, to_blocked: Column) -> Column:
    """Whether points must not be tied to the section."""
    sure = lambda c: F.coalesce(c, F.lit(False))
    return sure(fow.isin(*NOT_SNAPPABLE_FOW)) | sure(freeway == 1) | is_ferry(fow, feature) | passage_blocked(from_blocked) | passage_blocked(to_blocked)


def passage_blocked(code: Column) -> Column:
    return F.coalesce(code.isin(*BLOCKED_PASSAGE), F.lit(False))


def flat_time(kph: Column, metres: Column) -> Column:
    """Time with a tenth added; -1 where the speed is 0."""
    return F.when(kph == 0, F.lit(-1.0)).otherwise(metres * 1.1 / kph * 3.6)


def link_kmh(surface: Column, form: Column, road_class: Column) -> Column:
    """Speed of a harmonised link; the first rule that fits counts."""
    has = lambda part: F.coalesce(F.contains(road_class, F.lit(part)), F.lit(False))
    return (
        F.when(~surface.eqNullSafe(F.lit("paved")), 20)
        .when(form == "motorway", 120)
        .when(form == "dual_carriage_way", 100)
        .when(form == "slip_road", 80)
        .when(road_class == "main_road", 80)
        .when(has("first_class"), 80)
        .when(has("second_class"), 70)
        .when(has("third_class"), 50)
        .when(has("fourth_class"), 40)
        .otherwise(30)
    )


# What makes a harmonised link unusable.
UNUSABLE = {
    "form_of_way": ("tractor_road", "tractor_road#single_carriage_way", "single_carriage_way#tractor_road"),
    "access_restriction": ("physically_impossible", "private", "void_restricted#private", "void_restricted"),
    "condition_of_facility": ("disused", "under_construction"),
}


def link_usable(columns: dict[str, Column]) -> Column:
    """Whether no column has a value that bars use; null bars nothing."""
    ok = F.lit(True)
    for name, values in UNUSABLE.items():
        if name in columns:
            for v in values:
                ok = ok & ~columns[name].eqNullSafe(F.lit(v))
    return ok
