"""Lambert azimuthal equal-area, ETRS89-extended / LAEA Europe (EPSG:3035), by J. Snyder's formulas (1987)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# GRS80 and the projection's parameters.
SEMI_MAJOR, FLATTENING = 6378137.0, 1 / 298.257222101
LAT0, LON0 = math.radians(52.0), math.radians(10.0)
FALSE_EASTING, FALSE_NORTHING = 4321000.0, 3210000.0

_E2 = FLATTENING * (2 - FLATTENING)
_E = math.sqrt(_E2)


def _authalic(s, log):
    """q of the sine of a latitude."""
    return (s / (1 - s * s * _E2) - log((1 - s * _E) / (1 + s * _E)) / (2 * _E)) * (1 - _E2)


_QP = _authalic(1.0, math.log)
_BETA0 = math.asin(_authalic(math.sin(LAT0), math.log) / _QP)
_RQ = SEMI_MAJOR * math.sqrt(_QP / 2)
_D = SEMI_MAJOR * math.cos(LAT0) / (math.sqrt(1 - _E2 * math.sin(LAT0) ** 2) * _RQ * math.cos(_BETA0))


def to_laea(lat: Column, lon: Column) -> tuple[Column, Column]:
    """(easting, northing) in metres of degrees."""
    beta = F.asin(_authalic(F.sin(F.radians(lat)), F.ln) / _QP)
    turn = F.radians(lon) - LON0
    b = F.sqrt(F.lit(2.0) / (F.sin(beta) * math.sin(_BETA0) + F.cos(beta) * F.cos(turn) * math.cos(_BETA0) + 1)) * _RQ
    east = b * _D * F.cos(beta) * F.sin(turn) + FALSE_EASTING
    north = b / _D * (F.sin(beta) * math.cos(_BETA0) - F.cos(beta) * F.cos(turn) * math.sin(_BETA0)) + FALSE_NORTHING
    return east, north


def from_laea(east: Column, north: Column) -> tuple[Column, Column]:
    """(latitude, longitude) in degrees; the latitude's series is refined by two Newton steps."""
    x, y = (east - FALSE_EASTING) / _D, (north - FALSE_NORTHING) * _D
    rho = F.hypot(x, y)
    safe = F.when(rho == 0, F.lit(1.0)).otherwise(rho)
    c = F.asin(rho / (2 * _RQ)) * 2
    sine = F.when(rho == 0, F.lit(math.sin(_BETA0))).otherwise(F.cos(c) * math.sin(_BETA0) + y * F.sin(c) * math.cos(_BETA0) / safe)
    beta = F.asin(sine)
    lon = F.atan2(x * F.sin(c), rho * F.cos(c) * math.cos(_BETA0) - y * F.sin(c) * math.sin(_BETA0)) + LON0
    lat = beta
    for k, share in ((2, _E2 / 3 + 31 * _E2**2 / 180 + 517 * _E2**3 / 5040), (4, 23 * _E2**2 / 360 + 251 * _E2**3 / 3780), (6, 761 * _E2**3 / 45360)):
        lat = lat + F.sin(beta * k) * share
    for _ in range(2):
        s = F.sin(lat)
        lat = lat + (sine * _QP - _authalic(s, F.ln)) * (1 - s * s * _E2) ** 2 / (F.cos(lat) * 2 * (1 - _E2))
    return F.degrees(lat), F.degrees(lon)


def round_trip_error(lat: Column, lon: Column, east: Column, north: Column) -> Column:
    """Distance in metres between given and projected coordinates."""
    e, n = to_laea(lat, lon)
    return F.hypot(e - east, n - north)


def sub_points(x: Column, y: Column, offsets: list[tuple[int, int]]) -> Column:
    """Array of (code, x, y): a point's sub-points at the offsets, coded from 1."""
    return F.array(*[F.struct(F.lit(i).alias("code"), (x + dx).alias("x"), (y + dy).alias("y")) for i, (dx, dy) in enumerate(offsets, 1)])


def cross_offsets(step: int, arms: int) -> list[tuple[int, int]]:
    """The centre, then ``arms`` steps out in each of the four directions: 4 * arms + 1 offsets."""
    return [(0, 0)] + [(step * k * dx, step * k * dy) for dx, dy in ((0, 1), (1, 0), (0, -1), (-1, 0)) for k in range(1, arms + 1)]
