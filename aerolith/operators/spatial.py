"""Spatial joins: a cell is the index, the exact distance is the comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import at_border, distance_nm
from ..params import EndpointParams
from ..units import M_TO_FT


def spread(airports: DataFrame, radius_nm: float, lat: str = "apt_latitude_deg", lon: str = "apt_longitude_deg") -> DataFrame:
    """airports once for each whole-degree cell that any point within the radius can lie in: as many meridians as the latitude asks for, not a fixed three."""
    reach = radius_nm / 60
    by_lon = reach / F.greatest(F.cos(F.radians(F.least(F.abs(F.col(lat)) + reach, F.lit(89.0)))), F.lit(0.02))
    rows = airports.withColumn("cell_lat", F.explode(F.sequence(F.floor(F.col(lat) - reach), F.floor(F.col(lat) + reach))))
    return rows.withColumn("cell_lon", F.explode(F.sequence(F.floor(F.col(lon) - by_lon), F.floor(F.col(lon) + by_lon))))


def radius_join(points: DataFrame, airports: DataFrame, radius_nm: float, how: str = "inner", lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Pairs of points and airports within the radius, with dist_nm. how="left" keeps points without any airport.

    An equi-join on two whole numbers with the distance as a residual condition: the result does not depend on the cells, and a left join keeps its meaning. The airports' side is broadcast by the planner where it is small.
    """
    cells = points.withColumns({"_cell_lat": F.floor(F.col(lat)), "_cell_lon": F.floor(F.col(lon))})
    near = distance_nm(F.col(lat), F.col(lon), F.col("apt_latitude_deg"), F.col("apt_longitude_deg"))
    other = spread(airports, radius_nm)
    on = (cells["_cell_lat"] == other["cell_lat"]) & (cells["_cell_lon"] == other["cell_lon"]) & (near <= radius_nm)
    return cells.join(other, on, how).withColumn("dist_nm", near).drop("_cell_lat", "_cell_lon", "cell_lat", "cell_lon")


def cell_join(points: DataFrame, zones: DataFrame, cell: str, max_nm: float, refine: bool = True) -> DataFrame:
    """Points with the detection zones of their cell, out to a radius that is chosen when the zones are read; with refine, only pairs whose exact distance is within it."""
    own = zones.filter(F.col("apt_max_c_radius_nm") <= max_nm)
    rows = points.join(own, points[cell] == own["apt_hex_id"], "inner").withColumn("dist_nm", distance_nm(F.col("lat"), F.col("lon"), F.col("apt_latitude_deg"), F.col("apt_longitude_deg")))
    return rows.filter(F.col("dist_nm") <= max_nm) if refine else rows


def effective(dist: str | Column, scheduled: str | Column, penalty_nm: float) -> Column:
    """Distance with a penalty for aerodromes without scheduled service."""
    d = F.col(dist) if isinstance(dist, str) else dist
    s = F.col(scheduled) if isinstance(scheduled, str) else scheduled
    return d + F.when(s == "yes", 0.0).otherwise(float(penalty_nm)) if penalty_nm else d


def endpoints(sv: DataFrame, keep: list[str]) -> DataFrame:
    """(track_id, role, event_time, ..keep): a track's first row as adep and, if it has another, its last as ades. One aggregation with partial results, not a sort of all rows."""
    rows = sv.dropna(subset=["lat", "lon", "track_id"])
    order = F.struct("event_time", "lat", "lon")
    row = F.struct("event_time", *keep)
    ends = rows.groupBy("track_id").agg(F.min_by(row, order).alias("a"), F.max_by(row, order).alias("z"), F.count(F.lit(1)).alias("n"))
    first = F.struct(F.lit("adep").alias("role"), F.col("a").alias("row"))
    last = F.struct(F.lit("ades").alias("role"), F.col("z").alias("row"))
    both = F.when(F.col("n") > 1, F.array(first, last)).otherwise(F.array(first))
    return ends.select("track_id", F.explode(both).alias("e")).select("track_id", "e.role", "e.row.*")


def endpoint_candidates(sv: DataFrame, airports: DataFrame, max_nm: float = 110, how: str = "inner", p: EndpointParams = EndpointParams()) -> DataFrame:
    """Every aerodrome within reach of a track's ends, with distance, height above it and whether the end lies at the border. how="left" keeps ends without any."""
    ends = endpoints(sv, ["lat", "lon", "icao24", "callsign", "baro_altitude", "on_ground"])
    ends = ends.withColumn("at_border", at_border("lat", "lon", p.border_nm))
    rows = radius_join(ends, airports, max_nm, how)
    known = F.col("elevation_ft").isNotNull() if "elevation_ft" in airports.columns else F.lit(False)
    agl = F.col("baro_altitude") * M_TO_FT - F.col("elevation_ft") if "elevation_ft" in airports.columns else F.lit(None).cast("double")
    return rows.select(
        "track_id", "icao24", F.coalesce("callsign", F.lit("")).alias("flight_id"), "role", "event_time", "apt_ident", "dist_nm",
        effective("dist_nm", "apt_scheduled", p.scheduled_penalty_nm).alias("eff_nm"), agl.alias("agl_ft"), known.alias("elev_known"), "on_ground", "at_border", "lat", "lon", "apt_scheduled", "apt_type",
    )
