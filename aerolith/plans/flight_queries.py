"""Queries of spatial joins, zones, aerodrome naming, other methods and their scores."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import cells
from ..operators import clean, naming, research, score, spatial, zones
from ..params import Box
from . import views
from .core_queries import axial_sql
from .registry import query, r
from .views import VIEWS, angle_sql, epoch_sql

VIEWS["d"] = "d AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY track_id, event_time ORDER BY last_contact DESC NULLS LAST) AS rn FROM sm) WHERE rn = 1)"
_B = Box()
_BORDER = f"(lat <= {_B.south} + 0.5 OR lat >= {_B.north} - 0.5 OR lon <= {_B.west} + 0.5 / greatest(cos(radians(lat)), 0.1) OR lon >= {_B.east} - 0.5 / greatest(cos(radians(lat)), 0.1))"
VIEWS["ends"] = f"""ends AS (SELECT track_id, role, event_time, lat, lon, icao24, callsign, baro_altitude, on_ground, {_BORDER} AS at_border FROM (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY event_time, lat, lon) AS a,
 row_number() OVER (PARTITION BY track_id ORDER BY event_time DESC, lat DESC, lon DESC) AS z, count(*) OVER (PARTITION BY track_id) AS n FROM d WHERE lat IS NOT NULL AND lon IS NOT NULL), (VALUES ('adep'), ('ades')) r(role) WHERE (role = 'adep' AND a = 1) OR (role = 'ades' AND z = 1 AND n > 1))"""
#: As far as the flight list looks for an aerodrome.
REACH_NM = 110
_DIST = f"{angle_sql('lat', 'lon', 'apt_latitude_deg', 'apt_longitude_deg')} * 3440.065"


def cand_sql(radius: float, how: str = "", penalty: float = 10) -> str:
    return f"""cand AS (SELECT track_id, icao24, coalesce(callsign, '') AS flight_id, role, event_time, apt_ident, {_DIST} AS dist_nm, {_DIST} + CASE WHEN apt_scheduled = 'yes' THEN 0 ELSE {penalty} END AS eff_nm,
 baro_altitude * 3.28084 - elevation_ft AS agl_ft, elevation_ft IS NOT NULL AS elev_known, on_ground, at_border, lat, lon, apt_scheduled, apt_type FROM ends {how} JOIN apt ON {_DIST} <= {radius})"""


def sv(spark, sf, **also):
    return clean.drop_duplicates(views.sm(spark, sf, **also))


@query(
    "candidates_grid",
    f"SELECT apt_ident, count(*) AS n, round(avg({_DIST}), 6) AS mean_nm FROM d JOIN apt ON {_DIST} <= 40 WHERE baro_altitude * 3.28084 / 100 <= 40 GROUP BY apt_ident",
    "sm d apt",
)
def candidates_grid(spark, sf):
    return research.near(sv(spark, sf), views.apt(spark, sf), 40).groupBy("apt_ident").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("dist_nm"), 6).alias("mean_nm"))


@query("endpoint_candidates", f"%{cand_sql(REACH_NM)} SELECT track_id, role, event_time, apt_ident, round(dist_nm, 6) AS dist_nm, round(eff_nm, 6) AS eff_nm, round(agl_ft, 6) AS agl_ft, elev_known, on_ground, at_border FROM cand", "sm d ends apt")
def endpoint_candidates(spark, sf):
    rows = spatial.endpoint_candidates(sv(spark, sf), views.apt(spark, sf), REACH_NM)
    return rows.select("track_id", "role", F.col("event_time").cast("timestamp_ntz").alias("event_time"), "apt_ident", r("dist_nm"), r("eff_nm"), r("agl_ft"), "elev_known", "on_ground", "at_border")


_BEST = "best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY track_id, role ORDER BY eff_nm NULLS LAST, apt_ident NULLS LAST) AS rn FROM cand) WHERE rn = 1)"
_OK = "coalesce(dist_nm <= {r} AND (on_ground OR (elev_known AND agl_ft <= {h})), false)"


def named_sql(mode: str, radius: float = 40, height: float = 15000) -> str:
    if mode == "nearest":
        return f"{_BEST}, named AS (SELECT *, apt_ident AS named, CASE WHEN apt_ident IS NOT NULL THEN 'aerodrome' ELSE 'undetermined' END AS source FROM best)"
    ok = _OK.format(r=radius, h=height)
    return f"{_BEST}, named AS (SELECT *, CASE WHEN {ok} THEN apt_ident WHEN at_border THEN 'OOA' END AS named, CASE WHEN {ok} THEN 'aerodrome' WHEN at_border THEN 'out_of_area' ELSE 'undetermined' END AS source FROM best)"


def _name(mode: str) -> None:
    @query(f"name_{mode}", f"%{cand_sql(REACH_NM)}, {named_sql(mode)} SELECT track_id, role, named, source, round(dist_nm, 6) AS dist_nm FROM named", "sm d ends apt")
    def run(spark, sf):
        c = spatial.endpoint_candidates(sv(spark, sf), views.apt(spark, sf), REACH_NM)
        return naming.classify_endpoints(c, mode).select("track_id", "role", "named", "source", r("dist_nm"))


_name("nearest")
_name("endpoint")
_side = lambda role, c: f"max(CASE WHEN role = '{role}' THEN {c} END)"
_FLIGHTS = f"""others AS (SELECT c.track_id, c.role, string_agg(DISTINCT c.apt_ident, ', ' ORDER BY c.apt_ident) AS others FROM cand c JOIN named n ON c.track_id = n.track_id AND c.role = n.role AND c.apt_ident <> n.named GROUP BY c.track_id, c.role),
fl AS (SELECT track_id, {_side("adep", "icao24")} AS icao24, {_side("adep", "flight_id")} AS flight_id, CAST({_side("adep", "event_time")} AS DATE) AS dof, {_side("adep", "named")} AS adep, {_side("ades", "named")} AS ades,
 coalesce({_side("adep", "others")}, '') AS adep_p, coalesce({_side("ades", "others")}, '') AS ades_p, {_side("adep", "event_time")} AS first_seen, {_side("ades", "event_time")} AS last_seen,
 coalesce({_side("adep", "source")}, 'undetermined') AS adep_source, coalesce({_side("ades", "source")}, 'undetermined') AS ades_source, 'v3.0.0' AS version FROM named LEFT JOIN others USING (track_id, role) GROUP BY track_id)"""


def _flights(spark, sf):
    c = spatial.endpoint_candidates(sv(spark, sf), views.apt(spark, sf), REACH_NM)
    return naming.flights_from_endpoints(naming.classify_endpoints(c))


def ntz(df):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c, t in df.dtypes if t == "timestamp"})


@query("flights_endpoint", f"%{cand_sql(REACH_NM)}, {named_sql('endpoint')}, {_FLIGHTS} SELECT * FROM fl", "sm d ends apt")
def flights_endpoint(spark, sf):
    return ntz(_flights(spark, sf))


@query(
    "enrich",
    f"""%{cand_sql(REACH_NM)}, {named_sql("endpoint")}, {_FLIGHTS} SELECT track_id AS ID, fl.icao24 AS ICAO24, flight_id AS FLT_ID, dof AS DOF, adep AS ADEP, ades AS ADES, adep_p AS ADEP_P, ades_p AS ADES_P, registration AS REGISTRATION, model AS MODEL, typecode AS TYPECODE,
    icao_aircraft_class AS ICAO_AIRCRAFT_CLASS, icao_operator AS ICAO_OPERATOR, first_seen AS FIRST_SEEN, last_seen AS LAST_SEEN, version AS VERSION, adep_source AS ADEP_SOURCE, ades_source AS ADES_SOURCE FROM fl LEFT JOIN db ON fl.icao24 = db.icao24""",
    "sm d ends apt db",
)
def enrich(spark, sf):
    return ntz(naming.enrich(_flights(spark, sf), views.db(spark, sf)))


@query(
    "overflights",
    f"""%t AS (SELECT track_id, min(event_time) AS first_seen, max(event_time) AS last_seen, min(icao24) AS icao24, min(coalesce(callsign, '')) AS flight_id FROM d GROUP BY track_id)
    SELECT track_id, icao24, flight_id, CAST(first_seen AS DATE) AS dof, CAST(NULL AS VARCHAR) AS adep, CAST(NULL AS VARCHAR) AS ades, '' AS adep_p, '' AS ades_p, first_seen, last_seen FROM t
    WHERE {epoch_sql("last_seen")} - {epoch_sql("first_seen")} >= 300 AND track_id NOT IN (SELECT 'T' || o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
    "sm d",
)
def overflights(spark, sf):
    known = views.table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.expr("concat('T', o_orderkey)").alias("track_id"))
    return ntz(naming.overflights(sv(spark, sf), known))


# --- zones and the trend of altitude -------------------------------------------------------------------------------

RES, RADII = 6, zones.RADII


def zone_sql() -> str:
    bands = zones.rings(RADII)
    most = bands[-1][1]
    s = cells.side_nm(RES)
    steps = math.ceil(most * 1.15 / (1.5 * s)) + 1
    pick = lambda k: "CASE " + " ".join(f"WHEN dist < {b[1]} THEN {b[k]!r}" for b in bands) + " END"
    return f"""{axial_sql("zc", "apt", "apt_latitude_deg", "apt_longitude_deg", RES, "apt_ident, apt_latitude_deg, apt_longitude_deg, apt_type, apt_scheduled")},
zd AS (SELECT zc.*, dq, dr, (r + dr) * {1.5 * s!r}::DOUBLE / 60::DOUBLE AS clat, (q + dq + (r + dr) / 2::DOUBLE) * {cells._ROOT3 * s!r}::DOUBLE / {cells.LON_NM!r}::DOUBLE AS clon FROM zc, (SELECT unnest(range({-2 * steps}, {2 * steps + 1})) AS dq), (SELECT unnest(range({-steps}, {steps + 1})) AS dr)),
ze AS (SELECT *, {angle_sql("apt_latitude_deg", "apt_longitude_deg", "clat", "clon")} * 3440.065 AS dist FROM zd),
z AS (SELECT apt_ident, '{RES}:' || (q + dq) || ':' || (r + dr) AS apt_hex_id, CAST((abs(dq) + abs(dr) + abs(dq + dr)) // 2 AS INTEGER) AS distance_from_center, apt_latitude_deg, apt_longitude_deg, CAST({pick(0)} AS DOUBLE) AS apt_min_c_radius_nm, CAST({pick(1)} AS DOUBLE) AS apt_max_c_radius_nm, {pick(2)} AS ring, apt_type, apt_scheduled FROM ze WHERE dist < {most})"""


VIEWS["z"] = zone_sql()


def ring_zones(spark, sf):
    return zones.ring_zones(views.apt(spark, sf), RES, RADII)


@query("zone_rings", "SELECT apt_ident, apt_hex_id, distance_from_center, apt_min_c_radius_nm, apt_max_c_radius_nm, ring, apt_type, apt_scheduled FROM z", "apt z")
def zone_rings(spark, sf):
    return ring_zones(spark, sf).select("apt_ident", "apt_hex_id", "distance_from_center", "apt_min_c_radius_nm", "apt_max_c_radius_nm", "ring", "apt_type", "apt_scheduled")


_KEYS = "icao24, flight_id, track_id"
TREND_SQL = f"""lab0 AS (SELECT *, coalesce(callsign, '') AS flight_id, min(event_time) OVER (PARTITION BY track_id) AS first_seen, max(event_time) OVER (PARTITION BY track_id) AS last_seen FROM d WHERE lat IS NOT NULL AND lon IS NOT NULL AND baro_altitude IS NOT NULL),
lab1 AS (SELECT * FROM lab0 WHERE trunc(baro_altitude * 3.28084 / 100) <= 40),
{axial_sql("lab2", "lab1", "lat", "lon", RES, "track_id, icao24, flight_id, event_time, lat, lon, baro_altitude, first_seen, last_seen, k")},
lab AS (SELECT lab2.*, apt_ident, distance_from_center, apt_latitude_deg, apt_longitude_deg FROM lab2 JOIN z ON '{RES}:' || q || ':' || lab2.r = apt_hex_id WHERE apt_max_c_radius_nm <= 30),
sm5 AS (SELECT *, avg(baro_altitude) OVER (PARTITION BY {_KEYS}, apt_ident ORDER BY event_time, lat, lon ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS mean FROM lab),
ch AS (SELECT *, mean - lag(mean) OVER (PARTITION BY {_KEYS}, apt_ident ORDER BY event_time, lat, lon) AS change FROM sm5),
ud AS (SELECT *, count(*) FILTER (WHERE change > 0) OVER (PARTITION BY {_KEYS}, apt_ident) AS ups, count(*) FILTER (WHERE change < 0) OVER (PARTITION BY {_KEYS}, apt_ident) AS downs FROM ch),
st AS (SELECT *, CASE WHEN ups > downs + 4 THEN 'take-off' WHEN downs > ups + 4 THEN 'landing' ELSE 'ambiguous' END AS status FROM ud)"""


def _labelled(spark, sf):
    rows = sv(spark, sf).withColumn("cell", cells.cell("lat", "lon", RES))
    return naming.trend_status(naming.label_low(rows, ring_zones(spark, sf), "cell"))


@query("trend_status", f"%{TREND_SQL} SELECT track_id, apt_ident, max(ups) AS ups, max(downs) AS downs, max(status) AS status, count(*) AS n FROM st GROUP BY track_id, apt_ident", "sm d apt z")
def trend_status(spark, sf):
    return _labelled(spark, sf).groupBy("track_id", "apt_ident").agg(F.max("ups").alias("ups"), F.max("downs").alias("downs"), F.max("status").alias("status"), F.count(F.lit(1)).alias("n"))


_of = lambda s, c: f"max(CASE WHEN status = '{s}' THEN {c} END)"
TREND_FLIGHTS_SQL = f"""lst AS (SELECT *, min(distance_from_center) OVER (PARTITION BY {_KEYS}, status) AS least FROM st WHERE status <> 'ambiguous'),
at0 AS (SELECT *, row_number() OVER (PARTITION BY {_KEYS}, status, apt_ident ORDER BY event_time, lat, lon) AS fa, row_number() OVER (PARTITION BY {_KEYS}, status, apt_ident ORDER BY event_time DESC, lat DESC, lon DESC) AS fz FROM lst WHERE distance_from_center = least),
at1 AS (SELECT *, {angle_sql("lat", "lon", "apt_latitude_deg", "apt_longitude_deg")} * 6371.0 AS km FROM at0 WHERE (status = 'take-off' AND fa = 1) OR (status = 'landing' AND fz = 1)),
rk AS (SELECT *, row_number() OVER (PARTITION BY {_KEYS}, status ORDER BY km, apt_ident) AS n FROM at1),
bs AS (SELECT {_KEYS}, status, first_seen, last_seen, max(CASE WHEN n = 1 THEN apt_ident END) AS best, string_agg(DISTINCT apt_ident, ', ' ORDER BY apt_ident) FILTER (WHERE n > 1) AS others FROM rk GROUP BY {_KEYS}, status, first_seen, last_seen),
ft AS (SELECT {_KEYS}, first_seen, last_seen, CAST(first_seen AS DATE) AS dof, {_of("take-off", "best")} AS adep, {_of("landing", "best")} AS ades, coalesce({_of("take-off", "others")}, '') AS adep_p, coalesce({_of("landing", "others")}, '') AS ades_p FROM bs GROUP BY {_KEYS}, first_seen, last_seen)"""


@query(
    "flights_trend",
    f"%{TREND_SQL}, {TREND_FLIGHTS_SQL} SELECT *, CASE WHEN adep IS NOT NULL THEN 'aerodrome' ELSE 'undetermined' END AS adep_source, CASE WHEN ades IS NOT NULL THEN 'aerodrome' ELSE 'undetermined' END AS ades_source, 'v2.0.0' AS version FROM ft",
    "sm d apt z",
)
def flights_trend(spark, sf):
    return ntz(naming.flights_from_trend(_labelled(spark, sf)))


# --- other methods -------------------------------------------------------------------------------------------------

VIEWS["near"] = f"near AS (SELECT d.*, apt_ident, {_DIST} AS dist_nm FROM d JOIN apt ON {_DIST} <= 30 WHERE lat IS NOT NULL AND lon IS NOT NULL AND coalesce(baro_altitude * 3.28084 / 100 <= 40, true))"


def near(spark, sf):
    return research.near(sv(spark, sf), views.apt(spark, sf))


def _ranked(rows: str, order: str) -> str:
    return f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY track_id, role ORDER BY {order}) AS rn FROM {rows}) WHERE rn = 1)"


def _sides(rows: str, value: str = "apt_ident") -> str:
    return f"SELECT track_id, max(CASE WHEN role = 'adep' THEN {value} END) AS adep, max(CASE WHEN role = 'ades' THEN {value} END) AS ades FROM {rows} GROUP BY track_id"


M = {}
M["m0"] = f"""m0a AS (SELECT *, avg(baro_altitude) OVER (PARTITION BY track_id, apt_ident ORDER BY event_time ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS mean FROM near), m0b AS (SELECT *, mean - lag(mean) OVER (PARTITION BY track_id, apt_ident ORDER BY event_time) AS change FROM m0a),
m0c AS (SELECT track_id, apt_ident, sum(CASE WHEN change > 0 THEN 1 WHEN change < 0 THEN -1 ELSE 0 END) AS trend, min(dist_nm) AS nearest FROM m0b GROUP BY ALL), m0d AS (SELECT *, CASE WHEN trend > 4 THEN 'adep' ELSE 'ades' END AS role FROM m0c WHERE abs(trend) > 4),
m0 AS ({_sides(_ranked("m0d", "abs(trend) DESC, nearest, apt_ident"))})"""
M["m1"] = f"{cand_sql(40, 'LEFT', 0)}, m1 AS ({_sides(_ranked('cand', 'dist_nm NULLS LAST, apt_ident NULLS LAST'))})"
M["m2"] = """m2a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY track_id, event_time, lat, lon ORDER BY dist_nm, apt_ident) AS rn FROM near) WHERE rn = 1),
m2b AS (SELECT *, min(CASE WHEN NOT on_ground THEN event_time END) OVER (PARTITION BY track_id) AS fa, max(CASE WHEN NOT on_ground THEN event_time END) OVER (PARTITION BY track_id) AS la FROM m2a),
m2 AS (SELECT track_id, arg_max(apt_ident, event_time) FILTER (WHERE event_time < fa) AS adep, arg_min(apt_ident, event_time) FILTER (WHERE event_time > la) AS ades FROM m2b WHERE on_ground GROUP BY track_id HAVING count(*) FILTER (WHERE event_time < fa OR event_time > la) > 0)"""
M["m3"] = f"""m3a AS (SELECT track_id, apt_ident, sum(CASE WHEN vert_rate > 0.5 THEN 1 WHEN vert_rate < -0.5 THEN -1 ELSE 0 END) AS score, min(dist_nm) AS nearest FROM near GROUP BY ALL), m3b AS (SELECT *, CASE WHEN score > 0 THEN 'adep' ELSE 'ades' END AS role FROM m3a WHERE score <> 0),
m3 AS ({_sides(_ranked("m3b", "abs(score) DESC, nearest, apt_ident"))})"""
M["m5"] = f"""m5a AS (SELECT *, {epoch_sql("event_time")} AS t FROM near), m5b AS (SELECT *, CASE WHEN t <= (min(t) OVER (PARTITION BY track_id) + max(t) OVER (PARTITION BY track_id)) / 2.0::DOUBLE THEN 'adep' ELSE 'ades' END AS role FROM m5a),
m5 AS ({_sides(_ranked("m5b", "baro_altitude NULLS LAST, dist_nm, apt_ident, event_time"))})"""
M["m7"] = M["m1"].split(", m1 AS")[0] + f", m7a AS (SELECT *, CASE WHEN {_OK.format(r=20, h=15000)} THEN apt_ident WHEN at_border THEN 'OOA' END AS named FROM {_ranked('cand', 'dist_nm NULLS LAST, apt_ident NULLS LAST')}), m7 AS ({_sides('m7a', 'named')})"
_E = epoch_sql("event_time")
M["m8"] = f"""m8a AS (SELECT *, {_E} AS t, min({_E}) OVER (PARTITION BY track_id) AS t0, max({_E}) OVER (PARTITION BY track_id) AS t1, row_number() OVER (PARTITION BY track_id ORDER BY event_time, lat, lon) AS a, row_number() OVER (PARTITION BY track_id ORDER BY event_time DESC, lat DESC, lon DESC) AS z FROM d),
m8b AS (SELECT track_id, avg(CASE WHEN t <= t0 + 300 THEN vert_rate END) AS va, avg(CASE WHEN t >= t1 - 300 THEN vert_rate END) AS vz FROM m8a GROUP BY track_id),
m8c AS (SELECT m8a.track_id, 'adep' AS role, lat, lon, heading + 180 AS h, velocity, baro_altitude, va AS rate FROM m8a JOIN m8b USING (track_id) WHERE a = 1 UNION ALL SELECT m8a.track_id, 'ades', lat, lon, heading, velocity, baro_altitude, -vz FROM m8a JOIN m8b USING (track_id) WHERE z = 1),
m8d AS (SELECT *, least(coalesce(CASE WHEN rate > 0.5 THEN greatest(baro_altitude, 0.0) / rate END * velocity * 0.000539957, 0.0), 60.0) / 3440.065 AS g FROM m8c),
m8e AS (SELECT *, asin(sin(radians(lat)) * cos(g) + cos(radians(lat)) * sin(g) * cos(radians(h))) AS e FROM m8d),
m8f AS (SELECT track_id, role, degrees(e) AS lat, (lon + degrees(atan2(sin(radians(h)) * sin(g) * cos(radians(lat)), cos(g) - sin(radians(lat)) * sin(e))) + 540) % 360 - 180 AS lon FROM m8e),
m8g AS (SELECT track_id, role, apt_ident, {_DIST} AS dist_nm FROM m8f JOIN apt ON {_DIST} <= 20), m8 AS ({_sides(_ranked("m8g", "dist_nm, apt_ident"))})"""


def methods(spark, sf, *names: str):
    s, a = sv(spark, sf), views.apt(spark, sf)
    pairs = near(spark, sf)
    make = {
        "m0": lambda: research.m0_trend(pairs),
        "m1": lambda: research.m1_nearest(research.candidates_for(s, a)),
        "m2": lambda: research.m2_on_ground(pairs),
        "m3": lambda: research.m3_vertical_rate(pairs),
        "m5": lambda: research.m5_lowest(pairs),
        "m7": lambda: research.m7_abstaining(research.candidates_for(s, a)),
        "m8": lambda: research.m8_extrapolated(s, a),
    }
    return {n: make[n]() for n in names}


def _method(name: str) -> None:
    @query(f"method_{name}", f"%{M[name]} SELECT track_id, adep, ades FROM {name}", "sm d ends apt near")
    def run(spark, sf):
        return methods(spark, sf, name)[name]


for _m in M:
    _method(_m)

_LADDER = research.LADDER
_pick = lambda side, what: "coalesce(" + ", ".join(f"CASE WHEN {m}.{side} IS NOT NULL THEN {what(m, side)} END" for m in _LADDER) + ")"
CASCADE_SQL = (
    ", ".join(M[m] for m in _LADDER)
    + f""", ids AS ({" UNION ".join(f"SELECT track_id FROM {m}" for m in _LADDER)}),
casc AS (SELECT ids.track_id, {", ".join(f"{_pick(s, lambda m, side: f'{m}.{side}')} AS {s}, {_pick(s, lambda m, side: repr(m))} AS {s}_by" for s in ("adep", "ades"))} FROM ids {" ".join(f"LEFT JOIN {m} ON ids.track_id = {m}.track_id" for m in _LADDER)})"""
)


def _cascade(spark, sf, *also: str):
    return research.cascade_sides(research.ladder_sides(sv(spark, sf), views.apt(spark, sf)), _LADDER, *also)


@query("method_m6", f"%{CASCADE_SQL} SELECT track_id, adep, ades, adep_by, ades_by FROM casc", "sm d ends apt near")
def method_m6(spark, sf):
    return _cascade(spark, sf)


@query("only_aeroplanes", "SELECT d.track_id, count(*) AS n FROM d LEFT JOIN db ON d.icao24 = db.icao24 WHERE NOT coalesce(substr(icao_aircraft_class, 1, 1) IN ('H', 'G', 'T') OR lower(icao_aircraft_class) LIKE '%surface%', false) GROUP BY d.track_id", "sm d db")
def only_aeroplanes(spark, sf):
    return research.only_aeroplanes(sv(spark, sf), views.db(spark, sf)).groupBy("track_id").agg(F.count(F.lit(1)).alias("n"))


# --- scores --------------------------------------------------------------------------------------------------------

_INSIDE = f"apt_latitude_deg BETWEEN {_B.south} AND {_B.north} AND apt_longitude_deg BETWEEN {_B.west} AND {_B.east}"
VIEWS["al"] = f"""inb AS (SELECT apt_ident FROM apt WHERE {_INSIDE}),
lt AS (SELECT icao24, callsign, day, aobt_s, CASE WHEN adep IS NULL OR adep IN (SELECT apt_ident FROM inb) THEN adep ELSE 'OOA' END AS true_adep, CASE WHEN ades IS NULL OR ades IN (SELECT apt_ident FROM inb) THEN ades ELSE 'OOA' END AS true_ades FROM truth),
idt AS (SELECT track_id, lower(icao24) AS icao24, trim(callsign) AS callsign, CAST(event_time AS DATE) AS day, {_E} AS t_start FROM (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY event_time, icao24, callsign) AS rn FROM d) WHERE rn = 1),
al AS (SELECT * EXCLUDE (rn) FROM (SELECT lt.*, track_id, t_start, row_number() OVER (PARTITION BY lt.icao24, lt.callsign, lt.day, aobt_s ORDER BY abs(t_start - aobt_s) NULLS LAST, track_id NULLS LAST) AS rn FROM lt LEFT JOIN idt ON lt.icao24 = idt.icao24 AND lt.callsign = idt.callsign AND lt.day = idt.day) WHERE rn = 1)"""


_FILES = f"""SELECT CASE WHEN o_orderkey % 29 <> 0 THEN upper(lpad(HEX(o_custkey), 6, '0')) END AS AIRCRAFT_ADDRESS, concat('  F', o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN ' ' ELSE '' END) AS AIRCRAFT_ID,
 concat('A', o_custkey % 25) AS ADEP, CASE WHEN o_orderkey % 23 <> 0 THEN concat('A', o_orderkey * 7 % 25) END AS ADES, o_orderdate AS AOBT_3 FROM orders"""
TRUTH_DAYS = ["1994-03-01", "1995-06-17", "1996-01-02", "1996-11-30", "1997-07-04"]


@query(
    "truth_flights",
    f"""WITH f AS ({_FILES.replace("HEX(", "to_hex(")}) SELECT lower(AIRCRAFT_ADDRESS) AS icao24, trim(AIRCRAFT_ID) AS callsign, CAST(AOBT_3 AS DATE) AS day, {epoch_sql("AOBT_3")} AS aobt_s, ADEP AS adep, ADES AS ades
    FROM f WHERE AIRCRAFT_ADDRESS IS NOT NULL AND (CAST(AOBT_3 AS DATE) IN ({", ".join(f"DATE '{d}'" for d in TRUTH_DAYS)}) OR year(AOBT_3) = 1998)""",
)
def truth_flights(spark, sf):
    """Two files, of the odd orders and of the even; some days, and a year day by day."""
    views.table(spark, sf, "orders").createOrReplaceTempView("truth_orders")
    files = spark.sql(_FILES.replace("FROM orders", "FROM truth_orders").replace("HEX(", "hex("))
    odd = F.substring(F.trim("AIRCRAFT_ID"), 2, 20).cast("long") % 2 == 1
    year = [f"1998-{m:02d}-{d:02d}" for m in range(1, 13) for d in range(1, 32) if d <= (28 if m == 2 else 30 if m in (4, 6, 9, 11) else 31)]
    return score.truth_flights(files.filter(odd), files.filter(~odd), days=TRUTH_DAYS + year)


def aligned(spark, sf):
    return score.align(score.label_truth(views.truth(spark, sf), views.apt(spark, sf)), score.identities(sv(spark, sf)))


@query("align_nearest", "SELECT icao24, callsign, day, aobt_s, true_adep, true_ades, track_id, t_start FROM al", "sm d apt truth al")
def align_nearest(spark, sf):
    return aligned(spark, sf).select("icao24", "callsign", "day", "aobt_s", "true_adep", "true_ades", "track_id", "t_start")


def _score_sql() -> str:
    div = lambda a, b: f"round(CAST({a} AS DOUBLE) / nullif({b}, 0), 6)"
    n = lambda c: f"count(*) FILTER (WHERE {c})"
    out = ["count(*) AS n", "count(al.track_id) AS n_matched"]
    for s in ("adep", "ades"):
        t, g = f"true_{s}", s
        right, ooa, said = f"coalesce({t} = {g}, false)", f"coalesce({t} = 'OOA', false)", f"coalesce({g} = 'OOA', false)"
        known, given = f"{t} IS NOT NULL", f"{g} IS NOT NULL"
        inside = f"{known} AND NOT {ooa}"
        out += [f"{div(n(f'{known} AND {given}'), n(known))} AS {s}_coverage", f"{div(n(right), n(f'{known} AND {given}'))} AS {s}_accuracy", f"{div(n(right), n(known))} AS {s}_overall", f"{div(n(f'{ooa} AND {said}'), n(ooa))} AS {s}_ooa_recall", f"{div(n(f'{ooa} AND {said}'), n(f'{said} AND {known}'))} AS {s}_ooa_precision", f"{div(n(f'{inside} AND {given} AND NOT {said}'), n(inside))} AS {s}_inside_coverage", f"{div(n(f'{inside} AND {right}'), n(f'{inside} AND {given} AND NOT {said}'))} AS {s}_inside_accuracy"]
    return ", ".join(out)


@query("score", f"%{M['m7']} SELECT {_score_sql()} FROM al LEFT JOIN m7 ON al.track_id = m7.track_id", "sm d ends apt truth al near")
def score_m7(spark, sf):
    return score.score(aligned(spark, sf), methods(spark, sf, "m7")["m7"])


_PLACE = "CASE rung " + " ".join(f"WHEN '{m}' THEN {k}" for k, m in enumerate(_LADDER)) + " END"
_XSIDE = lambda s: f"SELECT '{s}' AS side, c.{s}_by AS rung, c.{s} AS got, true_{s} AS tr, b.{s} AS back FROM al JOIN casc c ON al.track_id = c.track_id LEFT JOIN m1 b ON al.track_id = b.track_id"


@query(
    "cascade_attr",
    f"""%{CASCADE_SQL}, x AS ({_XSIDE("adep")} UNION ALL {_XSIDE("ades")}), y AS (SELECT side, rung, count(*) AS n, count(*) FILTER (WHERE got = tr) AS correct, count(*) FILTER (WHERE back = tr) AS fallback_correct FROM x WHERE rung IS NOT NULL AND tr IS NOT NULL GROUP BY side, rung)
    SELECT side, CAST({_PLACE} AS INTEGER) AS place, rung, n, correct, fallback_correct, round(n::DOUBLE / CAST(sum(n) OVER (PARTITION BY side) AS DOUBLE), 6) AS share, round((correct - fallback_correct)::DOUBLE / n, 6) AS lift FROM y""",
    "sm d ends apt truth al near",
)
def cascade_attr(spark, sf):
    return score.cascade_attribution(aligned(spark, sf), _cascade(spark, sf, "m1_adep", "m1_ades").withColumnsRenamed({"m1_adep": "back_adep", "m1_ades": "back_ades"}), _LADDER)


_COLS = ["apt_ident", "dist_nm", "agl_ft", "elev_known", "on_ground", "at_border"]
_EV = M["m1"].split(", m1 AS")[0] + f", ev0 AS {_ranked('cand', 'dist_nm NULLS LAST, apt_ident NULLS LAST')}, ev AS (SELECT track_id, " + ", ".join(f"max(CASE WHEN role = '{s}' THEN {c} END) AS {s}_{c}" for s in ("adep", "ades") for c in _COLS) + " FROM ev0 GROUP BY track_id)"


@query("evidence", f"%{_EV} SELECT track_id, {', '.join(f'round({s}_dist_nm, 6) AS {s}_dist_nm, round({s}_agl_ft, 6) AS {s}_agl_ft, {s}_apt_ident, {s}_elev_known, {s}_on_ground, {s}_at_border' for s in ('adep', 'ades'))} FROM ev", "sm d ends apt")
def evidence(spark, sf):
    rows = research.pivot_evidence(research.candidates_for(sv(spark, sf), views.apt(spark, sf)))
    return rows.select("track_id", *[r(f"{s}_{c}") if c in ("dist_nm", "agl_ft") else f"{s}_{c}" for s in ("adep", "ades") for c in _COLS])


RADIUS_GRID, HEIGHT_GRID = [5, 10, 15, 20, 30, 40, 60, 80, 110], [500, 1000, 2000, 3000, 5000, 7500, 10000, 15000, 25000, 1000000000]
_EV_FAR = cand_sql(REACH_NM, "LEFT", 0) + _EV.removeprefix(M["m1"].split(", m1 AS")[0])
_swok = lambda s: f"coalesce({s}_dist_nm <= radius_nm AND ({s}_on_ground OR ({s}_elev_known AND {s}_agl_ft <= height_ft)), false)"
_swc = lambda s: f"round(count(*) FILTER (WHERE {_swok(s)} AND true_{s} IS NOT NULL)::DOUBLE / nullif(count(true_{s}), 0), 6) AS {s}_coverage, round(count(*) FILTER (WHERE {_swok(s)} AND true_{s} = {s}_apt_ident)::DOUBLE / nullif(count(*) FILTER (WHERE {_swok(s)} AND true_{s} IS NOT NULL), 0), 6) AS {s}_accuracy"


@query("sweep", f"%{_EV_FAR} SELECT radius_nm, height_ft, {_swc('adep')}, {_swc('ades')} FROM al LEFT JOIN ev ON al.track_id = ev.track_id, (SELECT unnest({RADIUS_GRID})::DOUBLE AS radius_nm), (SELECT unnest({HEIGHT_GRID})::DOUBLE AS height_ft) GROUP BY radius_nm, height_ft", "sm d ends apt truth al")
def sweep(spark, sf):
    ev = research.pivot_evidence(research.candidates_for(sv(spark, sf), views.apt(spark, sf), REACH_NM))
    return score.sweep(aligned(spark, sf), ev, RADIUS_GRID, HEIGHT_GRID)


PENALTIES = [0, 2, 5, 10, 15, 25]
_ph = lambda s: f"round(count(*) FILTER (WHERE {s} = true_{s})::DOUBLE / nullif(count(*) FILTER (WHERE {s} IS NOT NULL AND true_{s} IS NOT NULL), 0), 6) AS {s}_accuracy"


@query(
    "penalty_sweep",
    M["m1"].split(", m1 AS")[0].join(["%", ""]) + f""", pe AS (SELECT *, dist_nm + CASE WHEN apt_scheduled = 'yes' THEN 0.0 ELSE penalty_nm END AS eff FROM cand, (SELECT unnest({PENALTIES})::DOUBLE AS penalty_nm)),
    pb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY track_id, role, penalty_nm ORDER BY coalesce(eff, 1e9), apt_ident NULLS FIRST) AS rn FROM pe) WHERE rn = 1),
    pn AS (SELECT track_id, penalty_nm, max(CASE WHEN role = 'adep' THEN apt_ident END) AS adep, max(CASE WHEN role = 'ades' THEN apt_ident END) AS ades FROM pb GROUP BY track_id, penalty_nm)
    SELECT penalty_nm, {_ph("adep")}, {_ph("ades")} FROM al JOIN pn ON al.track_id = pn.track_id GROUP BY penalty_nm""",
    "sm d ends apt truth al",
)
def penalty_sweep(spark, sf):
    return score.penalty_sweep(aligned(spark, sf), research.candidates_for(sv(spark, sf), views.apt(spark, sf)), PENALTIES)


_pa = lambda s: f"SELECT '{s}' AS role, true_{s} AS apt, 1 AS truth, 0 AS assigned, CASE WHEN {s} = true_{s} THEN 1 ELSE 0 END AS correct FROM j UNION ALL SELECT '{s}', {s}, 0, 1, 0 FROM j"


@query(
    "per_airport",
    f"""%{M["m7"]}, j AS (SELECT al.*, adep, ades FROM al LEFT JOIN m7 ON al.track_id = m7.track_id), x AS ({_pa("adep")} UNION ALL {_pa("ades")}), y AS (SELECT role, apt, CAST(sum(truth) AS BIGINT) AS truth, CAST(sum(assigned) AS BIGINT) AS assigned, CAST(sum(correct) AS BIGINT) AS correct FROM x WHERE apt IS NOT NULL GROUP BY role, apt)
    SELECT *, round(correct::DOUBLE / truth, 6) AS recall, round(assigned::DOUBLE / truth, 6) AS ratio FROM y WHERE truth > 0""",
    "sm d ends apt truth al near",
)
def per_airport(spark, sf):
    return score.per_airport(aligned(spark, sf), methods(spark, sf, "m7")["m7"])


@query(
    "error_pairs",
    f"""%{M["m1"]}, x AS (SELECT 'adep' AS role, true_adep AS tr, adep AS got FROM al JOIN m1 ON al.track_id = m1.track_id UNION ALL SELECT 'ades', true_ades, ades FROM al JOIN m1 ON al.track_id = m1.track_id),
    n AS (SELECT role, tr, got, count(*) AS n FROM x WHERE tr <> got GROUP BY ALL ORDER BY n DESC, role, tr, got LIMIT 40)
    SELECT role, tr AS "true", got, n, round({angle_sql("a.apt_latitude_deg", "a.apt_longitude_deg", "b.apt_latitude_deg", "b.apt_longitude_deg")} * 3440.065, 6) AS apart_nm, a.apt_scheduled = 'yes' AND b.apt_scheduled = 'no' AS to_unscheduled FROM n LEFT JOIN apt a ON tr = a.apt_ident LEFT JOIN apt b ON got = b.apt_ident""",
    "sm d ends apt truth al near",
)
def error_pairs(spark, sf):
    return score.error_pairs(aligned(spark, sf), methods(spark, sf, "m1")["m1"], views.apt(spark, sf))


VIEWS["ts"] = f"ts AS (SELECT track_id, min(icao24) AS icao24, min(callsign) AS callsign, count(*) AS n, min(event_time) AS first_seen, max(event_time) AS last_seen, (max({_E}) - min({_E})) / 3600::DOUBLE AS hours FROM d GROUP BY track_id)"
_share = lambda c: f"round(avg(CASE WHEN {c} THEN 1.0::DOUBLE ELSE 0 END), 6)"


@query(
    "track_quality",
    f"""SELECT count(*) AS tracks, {_share("callsign IS NULL")} AS callsign_null, {_share("trim(callsign) = ''")} AS callsign_blank, {_share("trim(callsign) <> callsign")} AS callsign_padded,
    quantile_cont(n::DOUBLE, 0.5) AS rows_p50, quantile_cont(n::DOUBLE, 0.99) AS rows_p99, round(quantile_cont(hours, 0.5), 6) AS hours_p50, round(quantile_cont(hours, 0.99), 6) AS hours_p99,
    count(*) FILTER (WHERE {epoch_sql("first_seen")} - (SELECT min({epoch_sql("first_seen")}) FROM ts) <= 300 OR (SELECT max({epoch_sql("last_seen")}) FROM ts) - {epoch_sql("last_seen")} <= 300) AS at_edge FROM ts""",
    "sm d ts",
)
def track_quality(spark, sf):
    return score.track_quality(score.track_summary(sv(spark, sf)))


@query("fragmentation", "SELECT tracks, count(*) AS flights FROM (SELECT icao24, callsign, CAST(first_seen AS DATE) AS day, count(*) AS tracks FROM ts GROUP BY ALL) GROUP BY tracks", "sm d ts")
def fragmentation(spark, sf):
    return score.fragmentation(score.track_summary(sv(spark, sf)))




@query(
    "track_outliers",
    f"""SELECT CAST(count(*) FILTER (WHERE n = 1) AS BIGINT) AS single_row, count(*) FILTER (WHERE hours < 5::DOUBLE / 60) AS under_5min, count(*) FILTER (WHERE hours > 18) AS over_18h, round(max(hours), 6) AS hours_max,
    count(*) FILTER (WHERE {epoch_sql("first_seen")} - (SELECT epoch(CAST(min(first_seen) AS DATE)) FROM ts) < 300) AS starts_at_edge,
    count(*) FILTER (WHERE (SELECT epoch(CAST(max(last_seen) AS DATE)) FROM ts) + 86399 - {epoch_sql("last_seen")} < 300) AS ends_at_edge FROM ts""",
    "sm d ts",
)
def track_outliers(spark, sf):
    return score.track_outliers(score.track_summary(sv(spark, sf)))


@query(
    "merging",
    """%j AS (SELECT truth.*, track_id FROM truth JOIN idt ON truth.icao24 = idt.icao24 AND truth.callsign = idt.callsign AND truth.day = idt.day),
    f AS (SELECT count(*) AS met FROM j GROUP BY icao24, callsign, day, adep, ades), k AS (SELECT count(*) AS met FROM j GROUP BY track_id)
    SELECT (SELECT count(*) FROM f) AS matched_flights, (SELECT count(*) FROM f WHERE met > 1) AS fragmented_flights, (SELECT quantile_cont(met::DOUBLE, 0.99) FROM f) AS tracks_per_flight_p99, (SELECT max(met) FROM f) AS tracks_per_flight_max,
    (SELECT count(*) FROM k) AS matched_tracks, (SELECT count(*) FROM k WHERE met > 1) AS merged_tracks, (SELECT max(met) FROM k) AS flights_per_track_max""",
    "sm d apt truth al",
)
def merging(spark, sf):
    return score.merging(views.truth(spark, sf), score.identities(sv(spark, sf)))
