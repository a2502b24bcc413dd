"""Queries of track construction, geodesy, cells and cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cells, geo
from ..operators import clean, kinematics, sessionize
from ..params import SPIKE_LIMITS, TrackParams
from ..sources.readers import decimate
from . import views
from .registry import query, r
from .views import angle_sql, epoch_sql

#: The events of a user lie hours apart: sessions of a day, or half a day where low.
WIDE = TrackParams(gap_minutes=1440, low_gap_minutes=720)
TRACKS_SQL = f"""g AS (SELECT *, substr(sha256(concat_ws('', icao24, callsign)), 1, 16) AS gid FROM sv),
l AS (SELECT *, {epoch_sql("event_time")} - {epoch_sql("lag(event_time) OVER (PARTITION BY gid ORDER BY event_time)")} AS gap FROM g),
s AS (SELECT *, sum(CASE WHEN gap > 86400 OR (gap > 43200 AND baro_altitude < 1524) THEN 1 ELSE 0 END) OVER (PARTITION BY gid ORDER BY event_time ROWS UNBOUNDED PRECEDING) AS n FROM l),
tr AS (SELECT * EXCLUDE (gid, gap, n), gid || '_' || CAST(n AS BIGINT) || '_' || year(event_time) || '_' || month(event_time) AS track_id FROM s)"""
_STEP_SQL = f"{angle_sql('lag(lat) OVER w', 'lag(lon) OVER w', 'lat', 'lon')} * 6371.0 / 1.852"


def tracks(spark, sf) -> DataFrame:
    return sessionize.track_ids(views.sv(spark, sf), WIDE)


@query("track_id", f"%{TRACKS_SQL} SELECT event_id, track_id FROM tr", "sv")
def track_id(spark, sf):
    return tracks(spark, sf).select("event_id", "track_id")


@query(
    "track_summary",
    f"""%{TRACKS_SQL}, d AS (SELECT track_id, event_time, {_STEP_SQL} AS step FROM tr WINDOW w AS (PARTITION BY track_id ORDER BY event_time))
    SELECT track_id, count(*) AS n, min(event_time) AS first_seen, max(event_time) AS last_seen, round(sum(step), 4) AS distance_nm FROM d GROUP BY track_id""",
    "sv",
)
def track_summary(spark, sf):
    rows = kinematics.add_distances(tracks(spark, sf).select("track_id", "event_time", "lat", "lon"))
    return rows.groupBy("track_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("event_time").cast("timestamp_ntz").alias("first_seen"),
        F.max("event_time").cast("timestamp_ntz").alias("last_seen"),
        F.round(F.sum("segment_distance_nm"), 4).alias("distance_nm"),
    )


def _distance_sql(first: str) -> str:
    return f"""%{TRACKS_SQL}, d AS (SELECT event_id, track_id, event_time, coalesce({_STEP_SQL}, {first}) AS step FROM tr WINDOW w AS (PARTITION BY track_id ORDER BY event_time))
    SELECT event_id, round(step, 6) AS segment_distance_nm, round(sum(step) OVER (PARTITION BY track_id ORDER BY event_time ROWS UNBOUNDED PRECEDING), 4) AS cumulative_distance_nm,
    {epoch_sql("event_time")} - {epoch_sql("min(event_time) OVER (PARTITION BY track_id ORDER BY event_time)")} AS cumulative_time_s FROM d"""


def _distances(spark, sf, first):
    rows = kinematics.add_elapsed(kinematics.add_distances(tracks(spark, sf), first))
    return rows.select("event_id", r("segment_distance_nm"), r("cumulative_distance_nm", 4), "cumulative_time_s")


@query("segment_distance_tracks", _distance_sql("NULL"), "sv")
def segment_distance_tracks(spark, sf):
    return _distances(spark, sf, None)


@query("segment_distance_events", _distance_sql("0"), "sv")
def segment_distance_events(spark, sf):
    return _distances(spark, sf, 0)


@query(
    "altitude_smooth",
    f"""%e AS (SELECT *, {epoch_sql("event_time")} AS t FROM (SELECT *, row_number() OVER (PARTITION BY track_id, event_time ORDER BY last_contact DESC NULLS LAST) AS rn FROM sm) WHERE rn = 1),
    c AS (SELECT track_id, k, baro_altitude, abs((baro_altitude - lag(baro_altitude) OVER w) / nullif(t - lag(t) OVER w, 0)) AS roc, avg(baro_altitude) OVER (PARTITION BY track_id ORDER BY t RANGE BETWEEN 300 PRECEDING AND 300 FOLLOWING) AS mean FROM e WINDOW w AS (PARTITION BY track_id ORDER BY event_time))
    SELECT track_id, k, round(CASE WHEN roc > 25.4 THEN mean ELSE baro_altitude END, 4) AS baro_altitude_c FROM c""",
    "sm",
)
def altitude_smooth(spark, sf):
    rows = clean.drop_duplicates(views.sm(spark, sf))
    return kinematics.smooth_altitude(rows, "baro_altitude").select("track_id", "k", r("baro_altitude_c", 4))


@query(
    "geo_functions",
    f"""SELECT event_id, round({angle_sql("lat", "lon", "50.9014", "4.4844")} * 6371.0, 6) AS km, round({angle_sql("lat", "lon", "50.9014", "4.4844")} * 3440.065, 6) AS nm,
    round(CAST((degrees(atan2(sin(radians(4.4844) - radians(lon)) * cos(radians(50.9014)), cos(radians(lat)) * sin(radians(50.9014)) - sin(radians(lat)) * cos(radians(50.9014)) * cos(radians(4.4844) - radians(lon)))) + 360) % 360 AS DOUBLE), 6) AS bearing,
    CAST(trunc(baro_altitude * 3.28084 / 100) AS INTEGER) AS fl, round(baro_altitude * 3.28084 / 100, 6) AS fl_exact,
    (lat <= 26.74617 + 0.5 OR lat >= 70.25976 - 0.5 OR lon <= -25.86653 + 0.5 / greatest(cos(radians(lat)), 0.1) OR lon >= 49.65699 - 0.5 / greatest(cos(radians(lat)), 0.1)) AS border FROM sv""",
    "sv",
)
def geo_functions(spark, sf):
    return views.sv(spark, sf).select(
        "event_id",
        F.round(geo.distance("lat", "lon", 50.9014, 4.4844, "km"), 6).alias("km"),
        F.round(geo.distance_nm("lat", "lon", 50.9014, 4.4844), 6).alias("nm"),
        F.round(geo.bearing("lat", "lon", 50.9014, 4.4844), 6).alias("bearing"),
        geo.flight_level("baro_altitude").alias("fl"),
        F.round(geo.flight_level_exact("baro_altitude"), 6).alias("fl_exact"),
        geo.at_border("lat", "lon").alias("border"),
    )


@query(
    "geo_destination",
    """%d AS (SELECT event_id, lat, lon, heading, velocity / 3440.065 AS a, asin(sin(radians(lat)) * cos(velocity / 3440.065) + cos(radians(lat)) * sin(velocity / 3440.065) * cos(radians(heading))) AS e FROM sv)
    SELECT event_id, round(degrees(e), 6) AS lat2, round((lon + degrees(atan2(sin(radians(heading)) * sin(a) * cos(radians(lat)), cos(a) - sin(radians(lat)) * sin(e))) + 180 + 360) % 360 - 180, 6) AS lon2 FROM d""",
    "sv",
)
def geo_destination(spark, sf):
    rows = views.sv(spark, sf).select("event_id", geo.destination("lat", "lon", "heading", "velocity").alias("p"))
    return rows.select("event_id", F.round("p.lat", 6).alias("lat2"), F.round("p.lon", 6).alias("lon2"))


@query(
    "decimate_bbox",
    "SELECT event_id, date_trunc('second', event_time) AS event_time FROM sv WHERE lat BETWEEN 26.74617 AND 70.25976 AND lon BETWEEN -25.86653 AND 49.65699 AND CAST(floor(epoch(event_time)) AS BIGINT) % 5 = 0",
    "sv",
)
def decimate_bbox(spark, sf):
    rows = views.sv(spark, sf).withColumn("event_time", F.unix_timestamp("event_time"))
    return decimate(rows, every=5).select("event_id", F.timestamp_seconds("event_time").cast("timestamp_ntz").alias("event_time"))


# --- cells -------------------------------------------------------------------------------------------------------


def axial_sql(name: str, source: str, lat: str, lon: str, res: int, keep: str) -> str:
    """Common table expressions up to `name`, which has keep, q and r."""
    width = round(cells._ROOT3 * cells.side_nm(res), 12)
    return f"""{name}_a AS (SELECT {keep}, ({lon}) * {cells.LON_NM / width!r}::DOUBLE AS hx, ({lat}) * {cells.LAT_NM / width * cells._ROOT3!r}::DOUBLE AS hy FROM {source}),
{name}_b AS (SELECT *, floor(hx + hy + 1) AS up, floor((floor(hx + hy + 1) + floor(hy - hx + 1)) / 3) AS hr FROM {name}_a),
{name} AS (SELECT {keep}, CAST(floor((floor(2 * hx + 1) + up) / 3) - hr AS BIGINT) AS q, CAST(hr AS BIGINT) AS r FROM {name}_b)"""


@query("cell_encode", f"%{axial_sql('c7', 'sv', 'lat', 'lon', 7, 'event_id, lat, lon')}, {axial_sql('c12', 'sv', 'lat', 'lon', 12, 'event_id')} SELECT c7.event_id, '7:' || c7.q || ':' || c7.r AS h3_res_7, '12:' || c12.q || ':' || c12.r AS h3_res_12 FROM c7 JOIN c12 USING (event_id)", "sv")
def cell_encode(spark, sf):
    return kinematics.add_cells(views.sv(spark, sf)).select("event_id", "h3_res_7", "h3_res_12")


@query(
    "cell_distance",
    f"""%{axial_sql("c5", "sv", "lat", "lon", 5, "event_id, icao24, event_time")}, n AS (SELECT event_id, q - lag(q) OVER w AS dq, r - lag(r) OVER w AS dr FROM c5 WINDOW w AS (PARTITION BY icao24 ORDER BY event_time))
    SELECT event_id, CAST((abs(dq) + abs(dr) + abs(dq + dr)) // 2 AS INTEGER) AS steps FROM n""",
    "sv",
)
def cell_distance(spark, sf):
    from pyspark.sql import Window

    rows = views.sv(spark, sf).withColumn("c", cells.cell("lat", "lon", 5))
    before = F.lag("c").over(Window.partitionBy("icao24").orderBy("event_time"))
    return rows.select("event_id", cells.grid_distance(F.col("c"), before).alias("steps"))


@query(
    "cell_kring",
    f"""%{axial_sql("c6", "apt", "apt_latitude_deg", "apt_longitude_deg", 6, "apt_ident")}, d AS (SELECT x, y FROM (SELECT unnest(range(-2, 3)) AS x), (SELECT unnest(range(-2, 3)) AS y) WHERE abs(x + y) <= 2)
    SELECT apt_ident, '6:' || (q + x) || ':' || (r + y) AS cell, CAST((abs(x) + abs(y) + abs(x + y)) // 2 AS INTEGER) AS steps FROM c6, d""",
    "apt",
)
def cell_kring(spark, sf):
    rows = views.apt(spark, sf).withColumn("c", cells.cell("apt_latitude_deg", "apt_longitude_deg", 6))
    rows = rows.select("apt_ident", "c", F.explode(cells.k_ring(F.col("c"), 2, 6)).alias("cell"))
    return rows.select("apt_ident", "cell", cells.grid_distance(F.col("c"), F.col("cell")).alias("steps"))


@query(
    "cell_parent",
    f"""%{axial_sql("c7", "sv", "lat", "lon", 7, "event_id")}, m AS (SELECT event_id, r * (1.5::DOUBLE * {cells.side_nm(7)!r}::DOUBLE) / 60::DOUBLE AS clat, (q + r / 2::DOUBLE) * ({cells._ROOT3!r}::DOUBLE * {cells.side_nm(7)!r}::DOUBLE) / {cells.LON_NM!r}::DOUBLE AS clon FROM c7),
    {axial_sql("up", "m", "clat", "clon", 6, "event_id")} SELECT event_id, '6:' || q || ':' || r AS up FROM up""",
    "sv",
)
def cell_parent(spark, sf):
    return views.sv(spark, sf).select("event_id", cells.parent(cells.cell("lat", "lon", 7), 7).alias("up"))


# --- cleaning ----------------------------------------------------------------------------------------------------

T = epoch_sql("event_time")
CLEAN_SQL = {}
CLEAN_SQL["dedup"] = "c1 AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY track_id, event_time ORDER BY last_contact DESC NULLS LAST) AS rn FROM sm) WHERE rn = 1)"
CLEAN_SQL["range"] = "c2 AS (SELECT * REPLACE (CASE WHEN lat BETWEEN -90 AND 90 THEN lat END AS lat, CASE WHEN lon BETWEEN -180 AND 180 THEN lon END AS lon) FROM c1)"
_ch = lambda c: f"({c} IS NOT NULL AND coalesce({c} <> lag({c}) OVER w, true))"
CLEAN_SQL["stale"] = f"""c3a AS (SELECT *, {_ch("lat")} OR {_ch("lon")} AS m1, {_ch("lat")} OR {_ch("lon")} OR {_ch("baro_altitude")} AS m2, {_ch("vert_rate")} OR {_ch("heading")} OR {_ch("velocity")} AS m3 FROM c2 WINDOW w AS (PARTITION BY track_id ORDER BY event_time)),
c3 AS (SELECT * EXCLUDE (m1, m2, m3) REPLACE (CASE WHEN m1 THEN lat END AS lat, CASE WHEN m1 THEN lon END AS lon, CASE WHEN m2 THEN baro_altitude END AS baro_altitude, CASE WHEN m3 THEN vert_rate END AS vert_rate, CASE WHEN m3 THEN heading END AS heading, CASE WHEN m3 THEN velocity END AS velocity) FROM c3a)"""
_W = "(PARTITION BY track_id ORDER BY event_time ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_N = "(PARTITION BY track_id ORDER BY event_time ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"


def _prev(target: str, value: str) -> str:
    return f"last_value(CASE WHEN {value} IS NOT NULL THEN {target} END IGNORE NULLS) OVER {_W}"


def _next(target: str, value: str) -> str:
    return f"first_value(CASE WHEN {value} IS NOT NULL THEN {target} END IGNORE NULLS) OVER {_N}"


def _spike_sql() -> str:
    cols = list(SPIKE_LIMITS)
    each = lambda f: ", ".join(f(c) for c in cols)
    delta = lambda c: f"({f'(({c} - v_{c} + 180) % 360 + 360) % 360 - 180' if c == 'heading' else f'{c} - v_{c}'}) * {SPIKE_LIMITS[c][2]!r}"
    return f"""c4a AS (SELECT *, {T}::DOUBLE AS t FROM c3),
c4b AS (SELECT *, {each(lambda c: f"{_prev(c, c)} AS v_{c}, {_prev('t', c)} AS s_{c}")} FROM c4a),
c4c AS (SELECT *, {each(lambda c: f"{delta(c)} AS d_{c}, CASE WHEN {c} IS NOT NULL THEN t - s_{c} END AS h_{c}")} FROM c4b),
c4d AS (SELECT *, {each(lambda c: f"{_prev(f'd_{c}', c)} AS pd_{c}, {_prev(f'h_{c}', c)} AS ph_{c}")} FROM c4c),
c4e AS (SELECT *, {each(lambda c: f"CASE WHEN abs(d_{c}) / nullif(h_{c}, 0) >= {SPIKE_LIMITS[c][0]} THEN 1 ELSE 0 END AS f_{c}, CASE WHEN 2 * abs(d_{c} - pd_{c}) / nullif(h_{c} + ph_{c}, 0) >= {SPIKE_LIMITS[c][1]} THEN 1 ELSE 0 END AS g_{c}")} FROM c4d),
c4f AS (SELECT *, {each(lambda c: f"{_next(f'f_{c}', c)} AS nf_{c}, {_next(f'g_{c}', c)} AS ng_{c}")} FROM c4e),
c4g AS (SELECT *, {each(lambda c: f"{_next(f'ng_{c}', c)} AS nng_{c}")} FROM c4f),
c4 AS (SELECT c4g.* REPLACE ({each(lambda c: f"CASE WHEN f_{c} + coalesce(nf_{c}, 0) < 2 AND g_{c} + coalesce(ng_{c}, 0) + coalesce(nng_{c}, 0) < 2 THEN {c} END AS {c}")}) FROM c4g)"""


CLEAN_SQL["spike"] = _spike_sql()
_near = lambda c: f"CASE WHEN least(coalesce(t - {_prev('t', c)}, 1e9), coalesce({_next('t', c)} - t, 1e9)) <= 20 THEN {c} END AS {c}"
CLEAN_SQL["isolated"] = f"c5 AS (SELECT * REPLACE ({', '.join(_near(c) for c in clean.MASKED)}) FROM c4)"
CLEAN_SQL["segment"] = f"""c6a AS (SELECT *, CASE WHEN {T} - {epoch_sql("lag(event_time) OVER (PARTITION BY track_id ORDER BY event_time)")} >= 300 THEN 1 ELSE 0 END AS cut FROM c5),
c6 AS (SELECT *, track_id || '_' || CAST(1 + sum(cut) OVER (PARTITION BY track_id ORDER BY event_time ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment_id FROM c6a)"""
_STAGES = {"dedup": clean.drop_duplicates, "range": clean.mask_ranges, "stale": clean.mask_stale, "spike": clean.mask_spikes, "isolated": clean.mask_isolated, "segment": clean.add_segments}
_ROUNDED = ", ".join(f"round({c}, 6) AS {c}" for c in clean.MASKED)


def cleaned(spark, sf, upto: str) -> DataFrame:
    df = views.sm(spark, sf)
    for name, stage in _STAGES.items():
        df = stage(df)
        if name == upto:
            break
    return df


def _add(name: str, number: int) -> None:
    ctes = ",\n".join(list(CLEAN_SQL.values())[:number])
    more = ", segment_id" if name == "segment" else ""

    @query(f"clean_{name}", f"%{ctes} SELECT track_id, k, last_contact, {_ROUNDED}{more} FROM c{number}", "sm")
    def run(spark, sf):
        return cleaned(spark, sf, name).select("track_id", "k", "last_contact", *[r(c) for c in clean.MASKED], *(["segment_id"] if name == "segment" else []))


for _k, _name in enumerate(_STAGES, 1):
    _add(_name, _k)


@query("null_rate", "%" + ",\n".join(CLEAN_SQL.values()) + " SELECT " + ", ".join(f"round(avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0 END), 9) AS {c}" for c in clean.MASKED) + " FROM c6", "sm")
def null_rate(spark, sf):
    return clean.null_rates(clean.clean_tracks(views.sm(spark, sf))).select(*[r(c, 9) for c in clean.MASKED])
