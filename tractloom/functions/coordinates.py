"""Coordinate parsing, projection and distances as native columns.

Doubles stay unrounded: a radius test is an exact <= on the computed distance.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The numbers Python's float() reads, without inf, nan and digit separators; and GRS80 with the
# conterminous-US Albers parameters (EPSG:5070).
NUMBER = r"\A[\s]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[\s]*\z"
NONFINITE = r"(?i)\A[\s]*[+-]?(inf|infinity|nan)[\s]*\z"
GRS80_A, GRS80_INVERSE_F = 6378137.0, 298.257222101
LAT_0, LON_0, PARALLEL_1, PARALLEL_2 = 23.0, -96.0, 29.5, 45.5
EARTH_RADIUS_M = 6_371_008.8


def as_double(raw: Column) -> Column:
    """The number that the text states, else null; overflow gives infinity as in IEEE arithmetic."""
    return F.when(raw.rlike(NUMBER), F.regexp_replace(raw, r"\s", "").try_cast("double"))


def coordinate_state(latitude: Column, longitude: Column) -> Column:
    """missing, invalid_parse, invalid_nonfinite, invalid_range or valid, the first that holds."""
    lat, lon = as_double(latitude), as_double(longitude)
    blank = [c.isNull() | c.rlike(r"\A\s*\z") for c in (latitude, longitude)]
    readable = [c.rlike(NUMBER) | c.rlike(NONFINITE) for c in (latitude, longitude)]
    finite = [c.rlike(NUMBER) & (F.abs(v) < float("inf")) for c, v in ((latitude, lat), (longitude, lon))]
    return (
        F.when(blank[0] | blank[1], "missing")
        .when(~(readable[0] & readable[1]), "invalid_parse")
        .when(~(finite[0] & finite[1]), "invalid_nonfinite")
        .when(~(lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0)), "invalid_range")
        .otherwise("valid")
    )


def parsed_point(latitude: Column, longitude: Column) -> Column:
    """struct (state, latitude, longitude): parsed values are kept for valid and out-of-range points only."""
    state = coordinate_state(latitude, longitude)
    keep = state.isin("valid", "invalid_range")
    return F.struct(state.alias("state"), F.when(keep, as_double(latitude)).alias("latitude"), F.when(keep, as_double(longitude)).alias("longitude"))


def albers_constants() -> tuple[float, float, float, float]:
    """Eccentricity, cone constant n, C and rho_0 of the ellipsoidal equal-area cone (Snyder, USGS PP 1395, section 14)."""
    f = 1 / GRS80_INVERSE_F
    e2 = 2 * f - f * f
    e = math.sqrt(e2)

    def m(phi: float) -> float:
        return math.cos(phi) / math.sqrt(1 - e2 * math.sin(phi) ** 2)

    def q(phi: float) -> float:
        s = math.sin(phi)
        return (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))

    p0, p1, p2 = (math.radians(x) for x in (LAT_0, PARALLEL_1, PARALLEL_2))
    n = (m(p1) ** 2 - m(p2) ** 2) / (q(p2) - q(p1))
    c = m(p1) ** 2 + n * q(p1)
    return e, n, c, GRS80_A * math.sqrt(c - n * q(p0)) / n


def albers(longitude: Column, latitude: Column) -> Column:
    """struct (x, y) in metres of a point in degrees; null where an input is null or the result is not finite."""
    e, n, c, rho_0 = albers_constants()
    s = F.sin(F.radians(latitude))
    q = (1 - e * e) * (s / (1 - e * e * s * s) - F.log((1 - e * s) / (1 + e * s)) / (2 * e))
    rho = GRS80_A * F.sqrt(c - n * q) / n
    theta = n * F.radians(longitude - LON_0)
    x, y = rho * F.sin(theta), rho_0 - rho * F.cos(theta)
    return F.when(F.abs(x).isNotNull() & (F.abs(x) < float("inf")) & (F.abs(y) < float("inf")), F.struct(x.alias("x"), y.alias("y")))


def planar_distance_m(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.hypot(x1 - x2, y1 - y2)


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance on the mean sphere."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_RADIUS_M * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def unit_cell(latitude: Column, longitude: Column, size_m: float) -> Column:
    """The cube of edge size_m, in space about the sphere's centre, that a point lies in: points nearer than size_m
    to each other, at any latitude, lie in the same or touching cubes."""
    phi, lam, k = F.radians(latitude), F.radians(longitude), EARTH_RADIUS_M / size_m
    axes = {"i": F.cos(phi) * F.cos(lam), "j": F.cos(phi) * F.sin(lam), "k": F.sin(phi)}
    return F.struct(*[F.floor(v * k).cast("long").alias(name) for name, v in axes.items()])
