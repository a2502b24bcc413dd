"""Spherical geometry as column expressions. Plain numbers may stand in for columns; NULL in, NULL out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import Box
from ..units import EARTH_KM, EARTH_NM, EARTH_RING_KM, KM_PER_NM, M_TO_FT


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(float(x))


def central_angle(lat1, lon1, lat2, lon2) -> Column:
    """Angle between two points, in radians, by the haversine formula; its root is held to 1 against rounding, and stays NULL where a coordinate is."""
    a, b = F.radians(_c(lat1)), F.radians(_c(lat2))
    half_lat = F.sin((b - a) / 2)
    half_lon = F.sin((F.radians(_c(lon2)) - F.radians(_c(lon1))) / 2)
    root = F.sqrt(half_lat * half_lat + F.cos(a) * F.cos(b) * half_lon * half_lon)
    return 2 * F.asin(F.when(root > 1, 1.0).otherwise(root))


def distance(lat1, lon1, lat2, lon2, unit: str = "nm") -> Column:
    """Great-circle distance on the track sphere."""
    factors = {"km": EARTH_KM, "nm": EARTH_KM / KM_PER_NM, "m": EARTH_KM * 1000}
    if unit not in factors:
        raise ValueError(f"unknown unit {unit!r}; one of {sorted(factors)}")
    return central_angle(lat1, lon1, lat2, lon2) * factors[unit]


def distance_nm(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance on the candidate sphere."""
    return central_angle(lat1, lon1, lat2, lon2) * EARTH_NM


def bearing(lat1, lon1, lat2, lon2) -> Column:
    """Initial bearing, 0 to 360 degrees."""
    a, b, d = F.radians(_c(lat1)), F.radians(_c(lat2)), F.radians(_c(lon2)) - F.radians(_c(lon1))
    return F.pmod(F.degrees(F.atan2(F.sin(d) * F.cos(b), F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(d))) + 360, F.lit(360.0))


def _forward(lat, lon, towards, angle: Column) -> tuple[Column, Column]:
    a, t = F.radians(_c(lat)), F.radians(_c(towards))
    end = F.asin(F.sin(a) * F.cos(angle) + F.cos(a) * F.sin(angle) * F.cos(t))
    turn = F.atan2(F.sin(t) * F.sin(angle) * F.cos(a), F.cos(angle) - F.sin(a) * F.sin(end))
    return F.degrees(end), F.pmod(_c(lon) + F.degrees(turn) + 180, F.lit(360.0)) - 180


def destination(lat, lon, towards, dist_nm) -> Column:
    """struct(lat, lon) of the point at a bearing and distance."""
    lat2, lon2 = _forward(lat, lon, towards, _c(dist_nm) / EARTH_NM)
    return F.struct(lat2.alias("lat"), lon2.alias("lon"))


def circle(lat, lon, radius_nm, points: int = 360) -> Column:
    """array<struct(lat, lon)>: a closed ring of so many points around a centre."""
    angle = _c(radius_nm) * KM_PER_NM / EARTH_RING_KM

    def at(k: Column) -> Column:
        a, b = _forward(lat, lon, F.pmod(k, F.lit(points)) * 360.0 / points, angle)
        return F.struct(a.alias("lat"), b.alias("lon"))

    return F.transform(F.sequence(F.lit(0), F.lit(points)), at)


def circle_geojson(lat, lon, radius_nm, points: int = 360) -> Column:
    """The circle as a GeoJSON polygon in text form."""
    ring = F.transform(circle(lat, lon, radius_nm, points), lambda p: F.array(p["lon"], p["lat"]))
    return F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")))


def inside(ring: Column, lat, lon) -> Column:
    """Whether a point lies in a closed ring of struct(lat, lon), by the even-odd rule; holes and borders are not told apart."""
    y, x = _c(lat), _c(lon)
    sides = F.zip_with(F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring) - 1), lambda p, q: F.struct(p.alias("p"), q.alias("q")))

    def crosses(s: Column) -> Column:
        p, q = s["p"], s["q"]
        above = (p["lat"] > y) != (q["lat"] > y)
        return F.when(above & (x < F.try_divide((q["lon"] - p["lon"]) * (y - p["lat"]), q["lat"] - p["lat"]) + p["lon"]), 1).otherwise(0)

    return F.aggregate(sides, F.lit(0), lambda n, s: n + crosses(s)) % 2 == 1


def flight_level(metres) -> Column:
    """Whole flight level, cut off towards zero."""
    return (_c(metres) * M_TO_FT / 100).cast("int")


def flight_level_exact(metres) -> Column:
    return _c(metres) * M_TO_FT / 100


def flight_level_to_metres(fl) -> Column:
    return _c(fl) * 100 / M_TO_FT


def at_border(lat, lon, margin_nm: float = 30, box: Box = Box()) -> Column:
    """Whether a point lies within the margin of the box's border, or beyond it."""
    lat, lon = _c(lat), _c(lon)
    by_lat = F.lit(margin_nm / 60)
    by_lon = by_lat / F.greatest(F.cos(F.radians(lat)), F.lit(0.1))
    return (lat <= box.south + by_lat) | (lat >= box.north - by_lat) | (lon <= box.west + by_lon) | (lon >= box.east - by_lon)


def in_box(lat, lon, box: Box = Box()) -> Column:
    return _c(lat).between(box.south, box.north) & _c(lon).between(box.west, box.east)
