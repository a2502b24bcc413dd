"""Reference geometry as cells: detection rings, aerodrome layouts, airspaces. Nothing is collected."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cells
from ..functions.geo import distance_nm
from ..params import Box

#: Lower radii of the rings, NM; the last ring is ten wide.
RADII = (0, 5, 10, 15, 20, 25, 30, 35, 40, 50, 60, 70, 80, 90, 100, 110)


def rings(radii: tuple[float, ...] = RADII, last_width: float = 10) -> list[tuple[float, float, str]]:
    """(least, most, label) of each ring; the label names the outer radius."""
    outer = [*radii[1:], radii[-1] + last_width]
    return [(float(a), float(b), f"C{b:g}") for a, b in zip(radii, outer, strict=True)]


def airports_in(airports: DataFrame, box: Box = Box(), margin_deg: float = 3, types: tuple[str, ...] | None = None) -> DataFrame:
    """Airports of the wanted types inside the box widened by a margin."""
    rows = airports.filter(F.col("latitude_deg").between(box.south - margin_deg, box.north + margin_deg) & F.col("longitude_deg").between(box.west - margin_deg, box.east + margin_deg))
    return rows.filter(F.col("type").isin(*types)) if types else rows


def ring_zones(airports: DataFrame, res: int = 7, radii: tuple[float, ...] = RADII, last_width: float = 10) -> DataFrame:
    """A row for each cell whose centre lies within the outermost ring of an airport: its ring, and its grid distance from the airport's own cell.

    Cells are generated from the airport's own by axial steps, and a ring is found by distance. Nothing is subtracted from anything, and an airport's cells are never held together.
    """
    bands = rings(radii, last_width)
    most = bands[-1][1]
    steps = math.ceil(most * 1.15 / (1.5 * cells.side_nm(res))) + 1
    own = airports.withColumn("_own", cells.cell("apt_latitude_deg", "apt_longitude_deg", res)).filter("_own IS NOT NULL")
    _, q, r = cells.parts(F.col("_own"))
    rows = own.withColumns({"_q": q, "_r": r}).withColumn("_dq", F.explode(F.sequence(F.lit(-2 * steps), F.lit(2 * steps))))
    rows = rows.withColumn("_dr", F.explode(F.sequence(F.lit(-steps), F.lit(steps))))
    s = cells.side_nm(res)
    wide = cells._ROOT3 * s
    lat = (F.col("_r") + F.col("_dr")) * (1.5 * s) / cells.LAT_NM
    lon = (F.col("_q") + F.col("_dq") + (F.col("_r") + F.col("_dr")) / 2) * wide / cells.LON_NM
    rows = rows.withColumn("_dist", distance_nm(F.col("apt_latitude_deg"), F.col("apt_longitude_deg"), lat, lon)).filter(F.col("_dist") < most)
    band = F.lit(None)
    for a, b, label in reversed(bands):
        ring = F.struct(F.lit(a).alias("apt_min_c_radius_nm"), F.lit(b).alias("apt_max_c_radius_nm"), F.lit(label).alias("ring"))
        band = F.when(F.col("_dist") < b, ring).otherwise(band) if band is not None else ring
    rows = rows.withColumns({"apt_hex_id": cells._id(res, F.col("_q") + F.col("_dq"), F.col("_r") + F.col("_dr")), "distance_from_center": ((F.abs("_dq") + F.abs("_dr") + F.abs(F.col("_dq") + F.col("_dr"))) / 2).cast("int"), "_band": band})
    return rows.select("apt_ident", "apt_hex_id", "distance_from_center", "apt_latitude_deg", "apt_longitude_deg", "_band.apt_min_c_radius_nm", "_band.apt_max_c_radius_nm", "_band.ring", "apt_type", "apt_scheduled")


# --- layouts -------------------------------------------------------------------------------------------------------

#: The features wanted, with the width in metres of those that do not state one.
DEFAULT_WIDTH = {
    "taxiway": 30,
    "runway": 45,
    "apron": 20,
    "hangar": 20,
    "threshold": 45,
    "parking_position": 25,
    "deicing_pad": 60,
}


def to_metres(value: Column) -> Column:
    """A length with or without a unit (m, ft, ', mi); NULL if it is no number."""
    v = F.trim(F.lower(value))
    number = F.regexp_extract(v, r"^-?\d+(?:\.\d+)?", 0).try_cast("double")
    unit = F.trim(F.regexp_replace(v, r"^-?\d+(?:\.\d+)?", ""))
    return F.when(unit.isin("", "m", "metres", "meters"), number).when(unit.isin("ft", "feet", "'"), number * 0.3048).when(unit.isin("mi", "miles"), number * 1609.34)


def buffered(lat1: Column, lon1: Column, lat2: Column, lon2: Column, width_m: Column) -> Column:
    """A closed ring around a line, its corners a full width to each side."""
    metre_lat, metre_lon = 1 / 111195.0, 1 / (111195.0 * F.cos(F.radians(lat1)))
    dy, dx = (lat2 - lat1) / metre_lat, (lon2 - lon1) / metre_lon
    long = F.sqrt(dx * dx + dy * dy)
    ny, nx = F.coalesce(F.try_divide(dx, long), F.lit(0.0)) * width_m * metre_lat, F.coalesce(F.try_divide(-dy, long), F.lit(1.0)) * width_m * metre_lon
    at = lambda a, b: F.struct(a.alias("lat"), b.alias("lon"))
    return F.array(at(lat1 + ny, lon1 + nx), at(lat2 + ny, lon2 + nx), at(lat2 - ny, lon2 - nx), at(lat1 - ny, lon1 - nx), at(lat1 + ny, lon1 + nx))


def width_m() -> Column:
    """The width of a feature, stated or by its kind."""
    return F.coalesce(to_metres(F.col("width")), *[F.when(F.col("aeroway") == k, F.lit(float(v))) for k, v in DEFAULT_WIDTH.items()])


def with_rings(features: DataFrame) -> DataFrame:
    """features, whose shape is a closed ring or, where it has none, a line of points (both array<struct<lat,lon>>), with a ring for each: every segment of a line, or a single point, is widened to a ring of its own. A line without width has none."""
    if "line" not in features.columns:
        return features
    rows = features if "ring" in features.columns else features.withColumn("ring", F.lit(None).cast(features.schema["line"].dataType))
    n = F.size("line")
    next_ = F.when(n > 1, F.slice("line", 2, F.greatest(n - 1, F.lit(1)))).otherwise(F.col("line"))
    pairs = F.zip_with(F.when(n > 1, F.slice("line", 1, F.greatest(n - 1, F.lit(1)))).otherwise(F.col("line")), next_, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    segments = F.filter(F.transform(pairs, lambda s: buffered(s["a"]["lat"], s["a"]["lon"], s["b"]["lat"], s["b"]["lon"], F.col("_w"))), lambda _: F.col("_w").isNotNull())
    rings = F.when(F.col("ring").isNotNull(), F.array("ring")).otherwise(segments)
    return rows.withColumn("_w", width_m()).withColumn("ring", F.explode(rings)).drop("line", "_w")


def layouts(features: DataFrame, res: int = 12) -> DataFrame:
    """Cells of aerodrome features (apt_icao, osm_id, aeroway, ref, surface, width, length, type, ring): those whose centre lies inside the ring, each once for a feature, whose rings may overlap. Only outer rings count."""
    rows = cells.polyfill(features.withColumn("_w", width_m()), "ring", res, "_cell").withColumn("_at", cells.centre(F.col("_cell"), res))
    return rows.select(
        F.col("apt_icao").alias("layout_apt_icao"), F.col("_cell").alias("layout_h3_id"), F.col("_at.lat").alias("layout_latitude"), F.col("_at.lon").alias("layout_longitude"), F.lit(res).alias("layout_res"),
        F.col("aeroway").alias("layout_aeroway"), to_metres(F.col("length")).alias("layout_length"), F.col("ref").alias("layout_ref"), F.col("surface").alias("layout_surface"), F.col("_w").alias("layout_width"),
        F.col("osm_id").cast("long").alias("layout_osm_id"), F.col("type").alias("layout_type"),
    ).distinct()


# --- airspaces -----------------------------------------------------------------------------------------------------


def wkt_rings(wkt: Column) -> Column:
    """Outer rings, array<array<struct(lat, lon)>>, of a POLYGON or MULTIPOLYGON in text form."""
    body = F.regexp_replace(F.upper(F.trim(wkt)), r"^(MULTI)?POLYGON\s*Z?\s*", "")
    polygons = F.split(F.regexp_replace(body, r"\)\s*\)\s*,\s*\(\s*\(", ")|("), r"\|")
    outer = F.transform(polygons, lambda p: F.regexp_replace(F.get(F.split(p, r"\)\s*,\s*\("), F.lit(0)), r"[()]", ""))
    point = lambda xy: F.struct(F.get(F.split(F.trim(xy), r"\s+"), F.lit(1)).cast("double").alias("lat"), F.get(F.split(F.trim(xy), r"\s+"), F.lit(0)).cast("double").alias("lon"))
    return F.transform(outer, lambda o: F.transform(F.split(o, ","), point))


#: Validity of the publication cycles.
CYCLES = {
    406: ("2015-11-12", "2015-12-10"),
    481: ("2021-08-12", "2021-09-09"),
    524: ("2024-11-28", "2024-12-26"),
}


def airspaces(shapes: DataFrame, airspace_type: str, res: int = 7, compacted: bool = False) -> DataFrame:
    """Cells of airspaces (name, code, airac_cfmu, min_fl, max_fl, wkt), a polygon's parts side by side. Countries reach from the ground up and are always valid."""
    rows = shapes.withColumn("_ring", F.explode(wkt_rings(F.col("wkt"))))
    filled = cells.polyfill(rows, "_ring", res, "_cell")
    country = airspace_type == "COUNTRY"
    cycle = lambda k: F.coalesce(*[F.when(F.col("airac_cfmu").try_cast("int") == c, F.to_timestamp(F.lit(d[k]))) for c, d in CYCLES.items()])
    at = cells.centre(F.col("_cell"), res)
    out = filled.select(
        F.lit(airspace_type).alias("airspace_type"), "name", "code", (F.lit("-1") if country else F.col("airac_cfmu").cast("string")).alias("airac_cfmu"),
        (F.to_timestamp(F.lit("1900-01-01")) if country else cycle(0)).alias("validity_start"), (F.to_timestamp(F.lit("2100-01-01")) if country else cycle(1)).alias("validity_end"),
        (F.lit(0) if country else F.col("min_fl").cast("int")).alias("min_fl"), (F.lit(999) if country else F.col("max_fl").cast("int")).alias("max_fl"),
        F.col("_cell").alias("h3_res_7"), F.coalesce(at["lat"], F.lit(0.0)).alias("h3_res_7_lat"), F.coalesce(at["lon"], F.lit(0.0)).alias("h3_res_7_lon"),
    ).distinct()
    if not compacted:
        return out
    own = [c for c in out.columns if not c.startswith("h3_")]
    return cells.compact(out, "h3_res_7", res, own)
