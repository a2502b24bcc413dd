"""Aerodrome naming: flight lists by altitude trend or by track ends, enrichment and overflights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import distance, flight_level
from ..params import EndpointParams, TrendParams
from .spatial import cell_join, effective

FLIGHT_KEYS = ["icao24", "flight_id", "track_id"]


# --- by the ends of a track ---------------------------------------------------------------------------------------


def classify_endpoints(candidates: DataFrame, mode: str = "endpoint", p: EndpointParams = EndpointParams()) -> DataFrame:
    """(track_id, role, ..the best candidate's columns, apts, named, source): one row per end, apts being the names of all its candidates, sorted. One aggregate, without a window over all candidates.

    nearest: the nearest aerodrome by effective distance, whatever its distance. endpoint: it must be near and the end low over it, or on the
    ground; else an end at the border is out of area, else it stays undetermined. An aerodrome beats the border.
    """
    if mode not in ("nearest", "endpoint"):
        raise ValueError(f"unknown mode {mode!r}; nearest or endpoint")
    eff = F.coalesce(effective("dist_nm", "apt_scheduled", p.scheduled_penalty_nm), F.lit(1e18))
    others = [c for c in candidates.columns if c not in ("track_id", "role", "apt_ident")]
    best = candidates.groupBy("track_id", "role").agg(F.min(F.struct(eff.alias("_eff"), "apt_ident", *others)).alias("b"), F.array_sort(F.collect_set("apt_ident")).alias("apts"))
    best = best.select("track_id", "role", "b.apt_ident", *[f"b.{c}" for c in others], "apts")
    if mode == "nearest":
        named = F.col("apt_ident")
        source = F.when(named.isNotNull(), "aerodrome").otherwise("undetermined")
    else:
        low = F.col("on_ground") | (F.col("elev_known") & (F.col("agl_ft") <= p.height_ft))
        ok = F.coalesce((F.col("dist_nm") <= p.radius_nm) & low, F.lit(False))
        out = F.col("at_border") & F.lit(p.out_of_area)
        named = F.when(ok, F.col("apt_ident")).when(out, "OOA")
        source = F.when(ok, "aerodrome").when(out, "out_of_area").otherwise("undetermined")
    return best.withColumns({"named": named, "source": source})


def flights_from_endpoints(classified: DataFrame, version: str = "v3.0.0") -> DataFrame:
    """One row per track: both ends' names and sources, and the other candidates of a named end, sorted, as one string. Ends meet in one conditional aggregate, not in a join of two halves."""
    rows = classified.withColumn("others", F.when(F.col("named").isNotNull(), F.array_join(F.array_remove("apts", F.col("named")), ", ")))
    side = lambda role, c: F.max(F.when(F.col("role") == role, F.col(c)))
    return rows.groupBy("track_id").agg(
        side("adep", "icao24").alias("icao24"),
        side("adep", "flight_id").alias("flight_id"),
        F.to_date(side("adep", "event_time")).alias("dof"),
        side("adep", "named").alias("adep"),
        side("ades", "named").alias("ades"),
        F.coalesce(side("adep", "others"), F.lit("")).alias("adep_p"),
        F.coalesce(side("ades", "others"), F.lit("")).alias("ades_p"),
        side("adep", "event_time").alias("first_seen"),
        side("ades", "event_time").alias("last_seen"),
        F.coalesce(side("adep", "source"), F.lit("undetermined")).alias("adep_source"),
        F.coalesce(side("ades", "source"), F.lit("undetermined")).alias("ades_source"),
        F.lit(version).alias("version"),
    )


# --- by the trend of altitude near an aerodrome --------------------------------------------------------------------


def label_low(sv: DataFrame, zones: DataFrame, cell: str, p: TrendParams = TrendParams()) -> DataFrame:
    """Low state vectors inside a zone, with the track's first and last time over all its altitudes. Zones beyond the radius are left out when they are read."""
    rows = sv.dropna(subset=["lat", "lon", "baro_altitude", "track_id"]).withColumn("flight_id", F.coalesce("callsign", F.lit("")))
    whole = Window.partitionBy("track_id")
    rows = rows.withColumns({"first_seen": F.min("event_time").over(whole), "last_seen": F.max("event_time").over(whole), "flight_level": flight_level("baro_altitude")})
    rows = rows.filter(F.col("flight_level") <= p.max_fl).withColumn("dof", F.to_date("first_seen"))
    return cell_join(rows, zones, cell, p.radius_nm, refine=False)


def trend_status(labelled: DataFrame, p: TrendParams = TrendParams()) -> DataFrame:
    """labelled with status: take-off, landing or ambiguous, by how often the smoothed altitude rises and falls near the aerodrome. Window sums, no join back."""
    keys = [*FLIGHT_KEYS, "apt_ident"]
    w = Window.partitionBy(*keys).orderBy("event_time", "lat", "lon")
    whole = Window.partitionBy(*keys)
    rows = labelled.withColumn("_mean", F.avg("baro_altitude").over(w.rowsBetween(-2, 2)))
    rows = rows.withColumn("_change", F.col("_mean") - F.lag("_mean").over(w))
    rows = rows.withColumns({"ups": F.coalesce(F.sum(F.when(F.col("_change") > 0, 1)).over(whole), F.lit(0)), "downs": F.coalesce(F.sum(F.when(F.col("_change") < 0, 1)).over(whole), F.lit(0))})
    status = F.when(F.col("ups") > F.col("downs") + p.margin, "take-off").when(F.col("downs") > F.col("ups") + p.margin, "landing").otherwise("ambiguous")
    return rows.withColumn("status", status).drop("_mean", "_change")


def flights_from_trend(labelled: DataFrame, version: str = "v2.0.0") -> DataFrame:
    """One row per flight: of the aerodromes at the least grid distance, the nearest to the first take-off row or the last landing row; the others, sorted, as one string."""
    rows = labelled.filter("status <> 'ambiguous'")
    side = Window.partitionBy(*FLIGHT_KEYS, "status")
    rows = rows.withColumn("_least", F.min("distance_from_center").over(side)).filter("distance_from_center = _least")
    row = F.struct("event_time", "lat", "lon")
    keys = [*FLIGHT_KEYS, "status", "first_seen", "last_seen", "dof"]
    at = rows.groupBy(*keys, "apt_ident", "apt_latitude_deg", "apt_longitude_deg").agg(F.when(F.col("status") == "take-off", F.min(row)).otherwise(F.max(row)).alias("at"))
    at = at.withColumn("km", distance(F.col("at.lat"), F.col("at.lon"), F.col("apt_latitude_deg"), F.col("apt_longitude_deg"), "km"))
    ranked = at.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("km", "apt_ident"))).alias("r"))
    ranked = ranked.withColumns({"best": F.col("r")[0]["apt_ident"], "others": F.array_join(F.array_sort(F.array_distinct(F.slice(F.col("r"), 2, F.greatest(F.size("r") - 1, F.lit(1)))["apt_ident"])), ", ")})
    of = lambda status, c: F.max(F.when(F.col("status") == status, F.col(c)))
    out = ranked.groupBy(*FLIGHT_KEYS, "first_seen", "last_seen", "dof").agg(
        of("take-off", "best").alias("adep"),
        of("landing", "best").alias("ades"),
        F.coalesce(of("take-off", "others"), F.lit("")).alias("adep_p"),
        F.coalesce(of("landing", "others"), F.lit("")).alias("ades_p"),
    )
    source = lambda c: F.when(F.col(c).isNotNull(), "aerodrome").otherwise("undetermined")
    return out.withColumns({"adep_source": source("adep"), "ades_source": source("ades"), "version": F.lit(version)})


# --- both ----------------------------------------------------------------------------------------------------------


def enrich(flights: DataFrame, aircraft: DataFrame) -> DataFrame:
    """The flight list in its stored form: upper-case columns with the airframe's registration. The registry is reduced to one row per airframe first, so that flights are never multiplied."""
    one = aircraft.groupBy("icao24").agg(F.min(F.struct("registration", "model", "typecode", "icao_aircraft_class", "icao_operator")).alias("_a"))
    rows = flights.join(one, "icao24", "left").select("*", "_a.*")
    columns = ["icao24", ("flight_id", "FLT_ID"), "dof", "adep", "ades", "adep_p", "ades_p", "registration", "model", "typecode", "icao_aircraft_class", "icao_operator", "first_seen", "last_seen", "version"]
    columns += [c for c in ("adep_source", "ades_source") if c in flights.columns]
    return rows.select(F.col("track_id").alias("ID"), *[F.col(c).alias(c.upper()) if isinstance(c, str) else F.col(c[0]).alias(c[1]) for c in columns])


def overflights(sv: DataFrame, flights: DataFrame, least_seconds: int = 300, flight_id: str = "track_id") -> DataFrame:
    """Tracks that are not in the flight list and last long enough, without aerodromes. One aggregate per track and an anti-join."""
    rows = sv.dropna(subset=["track_id"])
    order = F.struct("event_time", "icao24", "callsign")
    ends = rows.groupBy("track_id").agg(F.min(order).alias("a"), F.min("event_time").alias("first_seen"), F.max("event_time").alias("last_seen"))
    ends = ends.filter(F.unix_timestamp("last_seen") - F.unix_timestamp("first_seen") >= least_seconds)
    left = ends.join(flights.select(F.col(flight_id).alias("track_id")), "track_id", "left_anti")
    none = F.lit(None).cast("string")
    return left.select("track_id", F.col("a.icao24").alias("icao24"), F.coalesce(F.col("a.callsign"), F.lit("")).alias("flight_id"), F.to_date("first_seen").alias("dof"), none.alias("adep"), none.alias("ades"), F.lit("").alias("adep_p"), F.lit("").alias("ades_p"), "first_seen", "last_seen")


def side_by_side(rows: DataFrame, value: str | Column = "apt_ident") -> DataFrame:
    """(track_id, adep, ades) from rows (track_id, role, apt_ident), one for each end at most."""
    v = F.col(value) if isinstance(value, str) else value
    return rows.groupBy("track_id").agg(*[F.max(F.when(F.col("role") == role, v)).alias(role) for role in ("adep", "ades")])
