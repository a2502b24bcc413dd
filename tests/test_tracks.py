"""Sessions, distances, smoothing, geodesy and cells against worked examples."""

import math
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from aerolith.functions import cells, geo
from aerolith.operators import kinematics, sessionize

T0 = datetime(2024, 6, 1, 12, tzinfo=timezone.utc)


def rows_of(spark, samples):
    return spark.createDataFrame([(T0 + timedelta(minutes=m), "abc123", c, a, 50.0, 4.0) for m, c, a in samples], "event_time timestamp, icao24 string, callsign string, baro_altitude double, lat double, lon double")


@pytest.mark.parametrize(("gap", "altitude", "cut"), [(30.0, 5000.0, False), (30.1, 5000.0, True), (16, 1000.0, True), (16, 2000.0, False), (16, None, False)])
def test_gap_rules(spark, gap, altitude, cut):
    ids = [r.track_id for r in sessionize.track_ids(rows_of(spark, [(0, "BEL1", 9000.0), (gap, "BEL1", altitude)])).orderBy("event_time").collect()]
    assert ids[0] == "4cf40d9d1ddce319_0_2024_6"
    assert ids[1] == ("4cf40d9d1ddce319_1_2024_6" if cut else ids[0])


def test_null_callsign_leaves_the_airframe(spark):
    assert sessionize.track_ids(rows_of(spark, [(0, None, 1.0)])).first().track_id.startswith("6ca13d52ca70c883_0")


def test_distances_begin_with_null_or_zero(spark, track):
    df = track([{"lat": 50.0}, {"lat": 50.1}, {"lat": 50.3}])
    a = kinematics.add_distances(df).orderBy("event_time").collect()
    assert a[0].segment_distance_nm is None and a[0].cumulative_distance_nm is None
    assert a[2].cumulative_distance_nm == pytest.approx(a[1].segment_distance_nm + a[2].segment_distance_nm)
    z = kinematics.add_distances(df, first=0).orderBy("event_time").collect()
    assert z[0].cumulative_distance_nm == 0 and z[2].cumulative_distance_nm == pytest.approx(a[2].cumulative_distance_nm)
    assert [r.cumulative_time_s for r in kinematics.add_elapsed(df).orderBy("event_time").collect()] == [0, 1, 2]


def test_smoothing_takes_the_mean_where_the_rate_is_impossible(track, values):
    df = track([{"t": 0, "baro_altitude": 1000.0}, {"t": 10, "baro_altitude": 1100.0}, {"t": 20, "baro_altitude": 3000.0}, {"t": 20, "baro_altitude": 3000.0}, {"t": 1000, "baro_altitude": None}])
    out = values(kinematics.smooth_altitude(df, "baro_altitude"), "baro_altitude_c")
    assert out[:2] == [1000, 1100] and out[4] is None
    assert pytest.approx((1000 + 1100 + 3000 + 3000) / 4) in out[2:4]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_geodesy(spark):
    ebbr, lfpg = (50.9014, 4.4844), (49.0097, 2.5478)
    assert one(spark, geo.distance(*ebbr, *lfpg, "km")) == pytest.approx(251.854692, abs=1e-6)
    assert one(spark, geo.distance(*ebbr, *lfpg)) == pytest.approx(135.990655, abs=1e-6)
    assert one(spark, geo.distance(*ebbr, *lfpg, "m")) == pytest.approx(251854.692, abs=1e-3)
    assert one(spark, geo.bearing(*ebbr, *lfpg)) == pytest.approx(214.116110, abs=1e-6)
    north, east = one(spark, geo.destination(*ebbr, 0.0, 100.0)), one(spark, geo.destination(*ebbr, 90.0, 100.0))
    assert (north.lat, north.lon) == (pytest.approx(52.566944, abs=1e-6), pytest.approx(4.4844))
    assert (east.lat, east.lon) == (pytest.approx(50.871622, abs=1e-6), pytest.approx(7.124241, abs=1e-6))
    with pytest.raises(ValueError):
        geo.distance(0.0, 0.0, 1.0, 1.0, "miles")


def test_flight_levels(spark):
    assert one(spark, geo.flight_level(3048.0)) == 100
    assert one(spark, geo.flight_level_exact(3048.0)) == pytest.approx(100.0000032)
    assert one(spark, geo.flight_level_to_metres(100.0)) == pytest.approx(3047.99, abs=0.01)


def test_border_and_circle(spark):
    assert one(spark, geo.at_border(26.8, 10.0)) and not one(spark, geo.at_border(50.0, 10.0)) and one(spark, geo.at_border(50.0, 60.0))
    ring = one(spark, geo.circle(50.0, 4.0, 30.0, 36))
    assert len(ring) == 37 and ring[0] == ring[-1]
    assert one(spark, geo.inside(geo.circle(50.0, 4.0, 30.0, 36), 50.2, 4.1)) and not one(spark, geo.inside(geo.circle(50.0, 4.0, 30.0, 36), 51.0, 4.0))
    assert '"type":"Polygon"' in one(spark, geo.circle_geojson(50.0, 4.0, 30.0, 8))


def test_cell_is_that_of_the_nearest_centre(spark):
    df = spark.range(400).select((47 + F.rand(1)).alias("lat"), (4 + F.rand(2)).alias("lon")).withColumn("c", cells.cell("lat", "lon", 7))
    around = df.withColumn("o", F.explode(cells.k_ring(F.col("c"), 1, 7)))
    plane = lambda p: F.pow((F.col("lat") - p["lat"]) * cells.LAT_NM, F.lit(2)) + F.pow((F.col("lon") - p["lon"]) * cells.LON_NM, F.lit(2))
    far = around.select("c", "o", plane(cells.centre(F.col("o"), 7)).alias("d"), plane(cells.centre(F.col("c"), 7)).alias("own"))
    assert far.filter("d < own - 1e-9").count() == 0


def test_rings_parents_children(spark):
    c = cells.cell(F.lit(50.0), F.lit(4.0), 7)
    assert len(one(spark, cells.k_ring(c, 1, 7))) == 7 and len(one(spark, cells.hex_ring(c, 3, 7))) == 18
    assert one(spark, cells.is_cell(c)) and not one(spark, cells.is_cell(F.lit("x"))) and one(spark, cells.resolution(c)) == 7
    assert one(spark, cells.cell(F.lit(None).cast("double"), F.lit(4.0), 7)) is None
    kids = one(spark, cells.children(cells.parent(c, 7), 6))
    assert one(spark, c) in kids and len(set(kids)) == len(kids)
    df = spark.createDataFrame([(k,) for k in kids], "c string")
    up = cells.compact(df, "c", 7)
    assert [r.c for r in up.collect()] == [one(spark, cells.parent(c, 7))]
    assert {r.c for r in cells.uncompact(up, "c", 7).collect()} == set(kids)
    assert cells.compact(df.limit(len(kids) - 1), "c", 7).count() == len(kids) - 1
    assert one(spark, cells.grid_distance(c, F.get(cells.hex_ring(c, 2, 7), F.lit(0)))) == 2


def test_polyfill_covers_the_area(spark):
    df = spark.range(1).select(geo.circle(50.0, 4.0, 10.0, 90).alias("ring"))
    n = cells.polyfill(df, "ring", 6).count()
    area = math.pi * 100 * math.cos(math.radians(48)) / math.cos(math.radians(50))
    assert n == pytest.approx(area / (cells.AREA_0_KM2 / 7**6 / 1.852**2), rel=0.1)


def test_geojson_round_trip(spark):
    df = spark.range(1).select(geo.circle(50.0, 4.0, 10.0, 12).alias("ring"), geo.circle_geojson(50.0, 4.0, 10.0, 12).alias("text"))
    r = df.select("ring", cells.geojson_ring(F.col("text")).alias("back")).first()
    assert [tuple(p) for p in r.back] == [tuple(p) for p in r.ring]
    assert one(spark, cells.geojson_ring(F.lit("no json"))) is None
