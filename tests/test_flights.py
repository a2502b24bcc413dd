"""Naming, events and scores against worked examples."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from aerolith.operators import events, monitor, naming, research, score, spatial, zones
from aerolith.params import Box, EndpointParams

T0 = datetime(2024, 6, 1, 12, tzinfo=timezone.utc)
CAND = "track_id string, icao24 string, flight_id string, role string, event_time timestamp, apt_ident string, dist_nm double, agl_ft double, elev_known boolean, on_ground boolean, at_border boolean, apt_scheduled string"


def cand(spark, *rows):
    return spark.createDataFrame([("T", "a", "f", "adep", T0, *r) for r in rows], CAND)


def named(df, **p):
    r = naming.classify_endpoints(df, p.pop("mode", "endpoint"), EndpointParams(**p)).first()
    return r.named, r.source


def test_endpoint_rule(spark):
    assert named(cand(spark, ("A", 39.0, 16000.0, True, False, True, "yes"))) == ("OOA", "out_of_area")
    assert named(cand(spark, ("A", 39.0, 16000.0, True, True, True, "yes"))) == ("A", "aerodrome")
    assert named(cand(spark, ("A", 39.0, 16000.0, True, False, False, "yes"))) == (None, "undetermined")
    assert named(cand(spark, (None, None, None, False, None, False, None)), mode="nearest") == (None, "undetermined")
    with pytest.raises(ValueError):
        naming.classify_endpoints(cand(spark), "other")


def test_scheduled_penalty(spark):
    two = cand(spark, ("A", 8.0, 0.0, True, True, False, "no"), ("B", 15.0, 0.0, True, True, False, "yes"))
    assert named(two)[0] == "B" and named(two, scheduled_penalty_nm=0)[0] == "A"
    flights = naming.flights_from_endpoints(naming.classify_endpoints(two)).first()
    assert (flights.adep, flights.adep_p, flights.ades, flights.ades_source) == ("B", "A", None, "undetermined")


def near_rows(spark, altitudes):
    rows = [("a", "f", "T", "A", T0 + timedelta(seconds=10 * k), 50.0, 4.0, float(h)) for k, h in enumerate(altitudes)]
    return spark.createDataFrame(rows, "icao24 string, flight_id string, track_id string, apt_ident string, event_time timestamp, lat double, lon double, baro_altitude double")


@pytest.mark.parametrize(("altitudes", "status"), [(range(0, 1000, 100), "take-off"), (range(1000, 0, -100), "landing"), ([0, 100, 200, 300, 200, 100, 0], "ambiguous"), ([100] * 8, "ambiguous")])
def test_trend(spark, altitudes, status):
    assert {r.status for r in naming.trend_status(near_rows(spark, list(altitudes))).collect()} == {status}


def test_radius_join_reaches_over_narrow_degrees(spark):
    pts = spark.createDataFrame([(1, 65.0, 10.95), (2, 10.0, 10.0)], "id int, lat double, lon double")
    apt = spark.createDataFrame([("A", 65.0, 9.5, "yes")], "apt_ident string, apt_latitude_deg double, apt_longitude_deg double, apt_scheduled string")
    assert [r.id for r in spatial.radius_join(pts, apt, 40).collect()] == [1]
    left = {r.id: r.apt_ident for r in spatial.radius_join(pts, apt, 40, "left").collect()}
    assert left == {1: "A", 2: None}


def test_endpoints_of_a_single_row(spark, track):
    ends = spatial.endpoints(track([{"t": 0}]), ["lat", "lon"]).collect()
    assert [e.role for e in ends] == ["adep"]
    assert sorted(e.role for e in spatial.endpoints(track([{"t": 0}, {"t": 5}]), ["lat"]).collect()) == ["adep", "ades"]


def test_overflights_need_five_minutes(spark, track):
    cols = track([{"t": 0}, {"t": 299}]).withColumn("callsign", F.lit("X"))
    none = spark.createDataFrame([], "track_id string")
    assert naming.overflights(cols, none).count() == 0
    longer = track([{"t": 0}, {"t": 300}]).withColumn("callsign", F.lit("X"))
    assert naming.overflights(longer, none).count() == 1
    assert naming.overflights(longer, spark.createDataFrame([("trk-1",)], "track_id string")).count() == 0


def test_enrichment_never_multiplies(spark):
    flights = spark.createDataFrame([("T", "a")], "track_id string, icao24 string").selectExpr("*", "'f' flight_id", "current_date() dof", "'A' adep", "'B' ades", "'' adep_p", "'' ades_p", "current_timestamp() first_seen", "current_timestamp() last_seen", "'v' version")
    db = spark.createDataFrame([("a", "R1"), ("a", "R2")], "icao24 string, registration string").selectExpr("*", "'m' model", "'t' typecode", "'L2J' icao_aircraft_class", "'o' icao_operator")
    rows = naming.enrich(flights, db).collect()
    assert len(rows) == 1 and rows[0].REGISTRATION == "R1"


# --- events --------------------------------------------------------------------------------------------------------


def phases(spark, samples):
    df = spark.createDataFrame([(float(k), *map(lambda v: None if v is None else float(v), s)) for k, s in enumerate(samples)], "k double, baro_altitude_c double, vert_rate double, velocity double")
    return [r.flight_phase for r in events.add_phase(df).orderBy("k").collect()]


def test_fuzzy_phases(spark):
    assert phases(spark, [(0, 0, 5), (2000, 10, 130), (2000, -8, 130), (11000, 0, 240), (3000, 0, 150)]) == ["GND", "CL", "DE", "CR", "LVL"]
    assert phases(spark, [(11000, 0, None), (None, None, None)]) == ["CR", None]


def test_activations(spark):
    a = events.activations(*[F.lit(float(v)) for v in (11000, 0, 240)])
    got = spark.range(1).select(*[c.alias(p) for c, p in zip(a, events.PHASES, strict=True)]).first()
    assert [round(got[p], 6) for p in events.PHASES] == [0, 0, 0, pytest.approx(0.410317, abs=1e-6), pytest.approx(0.033265, abs=1e-6)]


POINTS = {"GND": (0.0, 0.0, 5.0), "CL": (2000.0, 10.0, 130.0), "DE": (2000.0, -8.0, 130.0), "CR": (11000.0, 0.0, 240.0), "LVL": (3000.0, 0.0, 150.0)}


def milestones(spark, names, **p):
    from aerolith.params import EventParams

    rows = [("T", T0 + timedelta(seconds=60 * k), 50.0, 4.0, *POINTS[n], 0.0, 60 * k) for k, n in enumerate(names)]
    df = spark.createDataFrame(rows, "track_id string, event_time timestamp, lat double, lon double, baro_altitude_c double, vert_rate double, velocity double, cumulative_distance_nm double, cumulative_time_s int")
    got = {}
    for r in events.phase_milestones(df, EventParams(**p)).collect():
        got.setdefault(r.cumulative_time_s // 60, set()).add(r.type)
    return got


def test_milestones(spark):
    names = ["GND", "GND", "CL", "CL", "CR", "CR", "DE", "DE", "GND"]
    got = milestones(spark, names)
    assert got == {1: {"take-off"}, 2: {"take-off"}, 4: {"level-start", "top-of-climb"}, 5: {"level-end", "top-of-descent"}, 8: {"landing"}}
    assert 2 not in milestones(spark, names, first_takeoff_only=True)
    assert milestones(spark, ["CL", "CR", "DE"]) == {1: {"level-start", "top-of-climb"}}


def crossings(spark, levels):
    rows = [("T", T0 + timedelta(seconds=10 * k), 50.0, 4.0, fl * 100 / 3.28084, 0.0, 10 * k) for k, fl in enumerate(levels)]
    df = spark.createDataFrame(rows, "track_id string, event_time timestamp, lat double, lon double, baro_altitude_c double, cumulative_distance_nm double, cumulative_time_s int")
    return {r.type: r.cumulative_time_s // 10 for r in events.level_crossings(df).collect()}


def test_crossings(spark):
    assert crossings(spark, [48, 52, 49, 51]) == {"first-xing-fl50": 0, "last-xing-fl50": 2}
    assert crossings(spark, [45, 75]) == {"first-xing-fl50": 0, "last-xing-fl50": 0}
    assert crossings(spark, [30, 75]) == {}


def test_event_ids_follow_content(spark, track):
    df = events.with_progress(track([{"t": 0}, {"t": 60}]).withColumn("baro_altitude_c", F.col("baro_altitude")))
    a, b = (events.assemble([events.first_last_seen(df)]).orderBy("id").collect() for _ in range(2))
    assert a == b and len({r.id for r in a}) == 2
    m = events.measurements(events.assemble([events.first_last_seen(df)])).collect()
    assert len(m) == 4 and {r.milestone_id for r in m} == {r.id for r in a}


def test_infrastructure_traces(spark, track):
    df = events.with_progress(track([{"t": t, "baro_altitude": 0.0} for t in (0, 100, 500)]).withColumns({"baro_altitude_c": F.col("baro_altitude"), "h3_res_12": F.lit("c")}))
    flights = spark.createDataFrame([("trk-1", "F1", "A", None, "", "")], "track_id string, flight_id string, adep string, ades string, adep_p string, ades_p string")
    lay = spark.createDataFrame([("A", "c", 7, "runway", "09"), ("B", "c", 8, "runway", "27")], "layout_apt_icao string, layout_h3_id string, layout_osm_id long, layout_aeroway string, layout_ref string")
    got = events.infrastructure_events(df, flights, lay).orderBy("event_time").collect()
    assert [(r.type, r.cumulative_time_s) for r in got] == [("entry-runway", 0), ("exit-runway", 100)]
    assert '"osm_airport":"A"' in got[0].info and '"time_in_use_s":100' in got[0].info


# --- zones ---------------------------------------------------------------------------------------------------------


def test_rings_are_disjoint_and_complete(spark):
    apt = spark.createDataFrame([("A", 50.0, 4.0, "large_airport", "yes")], "apt_ident string, apt_latitude_deg double, apt_longitude_deg double, apt_type string, apt_scheduled string")
    z = zones.ring_zones(apt, 6, (0, 5, 10), 5)
    assert z.select("apt_hex_id").distinct().count() == z.count()
    assert {(r[0], r[1], r[2]) for r in z.select("apt_min_c_radius_nm", "apt_max_c_radius_nm", "ring").distinct().collect()} == {(0.0, 5.0, "C5"), (5.0, 10.0, "C10"), (10.0, 15.0, "C15")}
    assert z.filter("distance_from_center = 0").count() == 1


def test_lengths(spark):
    df = spark.createDataFrame([("150 ft",), ("20",), ("1.2 mi",), ("30 m",), ("wide",), (None,), ("-5",)], "v string")
    got = [r.x for r in df.select(zones.to_metres(F.col("v")).alias("x")).collect()]
    assert got == [pytest.approx(45.72), 20, pytest.approx(1931.208), 30, None, None, -5]


def test_wkt(spark):
    got = spark.createDataFrame([("MULTIPOLYGON (((4 50, 5 50, 5 51, 4 50), (4.1 50.1, 4.2 50.1, 4.2 50.2, 4.1 50.1)), ((1 2, 3 2, 3 4, 1 2)))",)], "w string").select(zones.wkt_rings(F.col("w")).alias("r")).first().r
    assert [len(x) for x in got] == [4, 4] and (got[0][0].lat, got[0][0].lon) == (50, 4) and got[1][2].lat == 4


# --- scores --------------------------------------------------------------------------------------------------------


def test_score_and_ooa(spark):
    apt = spark.createDataFrame([("A", 50.0, 4.0), ("Z", 0.0, 0.0)], "apt_ident string, apt_latitude_deg double, apt_longitude_deg double")
    truth = spark.createDataFrame([("A", "Z"), ("A", None), ("Q", "A")], "adep string, ades string")
    got = sorted((r.adep, r.ades) for r in score.label_truth(truth, apt).fillna("-").collect())
    assert got == [("A", "-"), ("A", "OOA"), ("OOA", "A")]
    al = spark.createDataFrame([("1", "A", "OOA"), ("2", "A", "B"), ("3", None, "OOA"), (None, "A", "A")], "track_id string, true_adep string, true_ades string")
    by = spark.createDataFrame([("1", "A", "OOA"), ("2", "B", None), ("3", "A", "A")], "track_id string, adep string, ades string")
    s = score.score(al, by).first()
    assert (s.n, s.n_matched, s.adep_coverage, s.adep_accuracy, s.adep_overall) == (4, 3, pytest.approx(0.666667), 0.5, pytest.approx(0.333333))
    assert (s.ades_ooa_recall, s.ades_ooa_precision) == (0.5, 1.0)
    assert score.score(al.limit(0), by).first().adep_coverage is None


def test_cascade_takes_the_first_that_names(spark):
    m = lambda *r: spark.createDataFrame(list(r), "track_id string, adep string, ades string")
    got = research.cascade({"m0": m(("1", "A", None)), "m1": m(("1", "X", "B"), ("2", None, "C"))}, ("m0", "m1")).orderBy("track_id").collect()
    assert [(r.adep, r.adep_by, r.ades, r.ades_by) for r in got] == [("A", "m0", "B", "m1"), (None, None, "C", "m1")]


def test_unknown_class_stays(spark):
    sv = spark.createDataFrame([("h",), ("l",), ("n",), ("x",)], "icao24 string")
    db = spark.createDataFrame([("h", "H1T"), ("l", "L2J"), ("n", None)], "icao24 string, icao_aircraft_class string")
    assert {r.icao24 for r in research.only_aeroplanes(sv, db).collect()} == {"l", "n", "x"}
    assert {r.icao24 for r in research.only_aeroplanes(sv, db, strict=True).collect()} == {"l"}


def test_outages_and_labels(spark):
    days = spark.sql("SELECT explode(sequence(date'2023-11-14', date'2023-11-17')) AS day, 5432L AS n")
    got = {str(r.day): r.explanation for r in monitor.explain(monitor.with_outage(days, monitor.outages(spark))).collect()}
    period = "2023-11-15 06:00:00 to 2023-11-16 08:00:00"
    assert got == {"2023-11-14": "Low count (5,432)", "2023-11-15": f"Low count (5,432); Known outage: {period}", "2023-11-16": f"Low count (5,432); Known outage: {period}", "2023-11-17": "Low count (5,432)"}
    enough = monitor.with_outage(days, monitor.outages(spark))
    assert {r.explanation for r in monitor.explain(enough, 5432).collect()} == {"OK"}
    assert monitor.fill_days(days.limit(0)).count() == 0


def test_box_is_a_parameter():
    assert Box().west < Box().east


def test_merging(spark):
    truth = spark.createDataFrame([("a", "X", "d", "P", "Q"), ("a", "X", "d", "Q", None), ("b", "Y", "d", "P", "Q"), ("c", None, "d", "P", "Q"), ("e", "Z", "d", "P", "Q")], "icao24 string, callsign string, day string, adep string, ades string")
    tracks = spark.createDataFrame([("1", "a", "X", "d"), ("2", "b", "Y", "d"), ("3", "b", "Y", "d"), ("4", "b", "Y", "other"), ("5", "c", None, "d")], "track_id string, icao24 string, callsign string, day string")
    r = score.merging(truth, tracks).first()
    assert (r.matched_flights, r.fragmented_flights, r.tracks_per_flight_max) == (3, 1, 2)
    assert (r.matched_tracks, r.merged_tracks, r.flights_per_track_max) == (3, 1, 2)
    none = score.merging(truth, tracks.limit(0)).first()
    assert (none.matched_flights, none.merged_tracks, none.flights_per_track_max) == (0, 0, None)


def test_outlying_tracks(spark):
    rows = [("1", 1, T0, T0, 0.0), ("2", 9, T0, T0 + timedelta(minutes=4), 4 / 60), ("3", 9, T0, T0 + timedelta(hours=19), 19.0), ("4", 5, T0 - timedelta(hours=11, minutes=58), T0 + timedelta(hours=6), 18.0)]
    df = spark.createDataFrame(rows, "track_id string, n long, first_seen timestamp, last_seen timestamp, hours double")
    r = score.track_outliers(df, "2024-06-01", "2024-06-02").first()
    assert tuple(r) == (1, 2, 1, 19.0, 1, 0)
