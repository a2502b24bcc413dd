"""What grows with the samples of a track stays where the track is: queries move flights, not their samples, and make the samples as few times as they can."""

import re

import pytest

SF = "/root/testdata/sf0.001"


def moved(plan: str) -> list[str]:
    """Exchanges of a plan with samples below them, which the view expands by k."""
    lines, out = plan.splitlines(), []
    depth = lambda x: re.search(r"[A-Za-z*(]", x).start() if re.search(r"[A-Za-z*(]", x) else 0
    for k, line in enumerate(lines):
        if re.search(r"\bExchange hashpartitioning", line):
            below = []
            for x in lines[k + 1 :]:
                if depth(x) <= depth(line):
                    break
                below.append(x)
            if any("Generate explode" in x and " k#" in x.rsplit("[", 1)[-1] for x in below):
                out.append(line)
    return out


def plan_of(spark, name):
    from aerolith.plans.queries import QUERIES

    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def samples(plan: str) -> int:
    """How many times a plan makes the samples."""
    return sum("Generate explode" in x and bool(re.search(r"\[k#\d+L?\]", x)) for x in plan.splitlines())


@pytest.mark.parametrize(("name", "times"), [("events_all", 2), ("measurements", 2), ("cascade_attr", 2), ("method_m6", 1)])
def test_samples_are_not_moved(spark, name, times):
    plan = plan_of(spark, name)
    assert not moved(plan)
    assert 1 <= samples(plan) <= times


@pytest.mark.parametrize("name", ["measurements", "method_m6"])
def test_flights_are_moved_without_their_names(spark, name):
    dealt = [x for x in plan_of(spark, name).splitlines() if "REPARTITION_BY_NUM" in x]
    assert dealt and all("concat(T, cast(o_orderkey#" in x and "track_id" not in x for x in dealt)


def test_a_pass_over_a_track_gives_the_events_of_its_families(spark, track):
    from pyspark.sql import functions as F

    from aerolith.operators import events
    from aerolith.params import EventParams

    climb = [{"t": 10 * k, "lat": 50 + k / 100, "baro_altitude": min(k, 60 - k) * 400.0, "vert_rate": 8.0 if k < 25 else -8.0 if k > 35 else 0.0, "velocity": 0.0 if k in (0, 60) else 150.0} for k in range(61)]
    rows = track([*climb, climb[0], climb[30], climb[60], {"t": 300, "lat": None, "baro_altitude": None}])
    rows = events.with_progress(rows.withColumn("baro_altitude_c", F.col("baro_altitude"))).persist()
    for p in (EventParams(), EventParams(first_takeoff_only=True)):
        families = events.phase_milestones(rows, p).unionByName(events.level_crossings(rows, p)).unionByName(events.first_last_seen(rows, p))
        want, got = families.collect(), events.track_events(rows, p).collect()
        assert sorted(map(str, got)) == sorted(map(str, want)) and len({r.type for r in got}) >= 8
    rows.unpersist()


def test_a_pass_over_a_track_names_what_the_methods_name(spark):
    from aerolith.operators import research

    h = lambda n, salt: f"pmod(hash(id, '{salt}'), {n})"
    sv = spark.range(3000).selectExpr(
        "concat('T', id % 90) AS track_id", "timestamp_seconds(1717243200 + id * 10) AS event_time", "'abc123' AS icao24", "'F1' AS callsign",
        f"CASE WHEN {h(15, 'n')} > 0 THEN 50 + {h(90, 'a')} / 60D + id % 90 DIV 85 * 5 END AS lat", f"4 + {h(90, 'o')} / 60D AS lon",
        f"CASE WHEN {h(11, 'b')} > 0 THEN CAST(id DIV 90 * IF(id % 2 = 0, 40, -40) + IF(id % 2 = 0, 0, 1400) + {h(60, 'h')} AS DOUBLE) END AS baro_altitude",
        f"CASE WHEN {h(7, 'v')} > 0 THEN {h(9, 'r')} - 4D END AS vert_rate", f"CASE WHEN {h(9, 'g')} > 0 THEN id DIV 90 < {h(6, 's')} OR id DIV 90 > 28 END AS on_ground",
    )
    sv = sv.unionByName(sv.limit(1).selectExpr("'one' AS track_id", "event_time", "icao24", "callsign", "50.5D AS lat", "4.5D AS lon", "baro_altitude", "vert_rate", "true AS on_ground")).persist()
    airports = spark.range(9).selectExpr("concat('A', id) AS apt_ident", "50.2 + id DIV 3 * 0.5D AS apt_latitude_deg", "4.2 + id % 3 * 0.6D AS apt_longitude_deg", "10D AS elevation_ft", "'yes' AS apt_scheduled", "'large_airport' AS apt_type")
    for fl in (40, 10, None):
        pairs, ends = research.near(sv, airports, 30, fl), research.candidates_for(sv, airports)
        one = {"m0": research.m0_trend(pairs), "m1": research.m1_nearest(ends), "m2": research.m2_on_ground(pairs), "m3": research.m3_vertical_rate(pairs), "m5": research.m5_lowest(pairs)}
        sides = research.ladder_sides(sv, airports, 30, fl).persist()
        for m, want in one.items():
            got = sides.select("track_id", f"{m}_adep", f"{m}_ades").filter("true" if m == "m1" else f"{m}_adep IS NOT NULL OR {m}_ades IS NOT NULL")
            rows = sorted(map(tuple, want.select("track_id", "adep", "ades").collect()), key=str)
            assert sorted(map(tuple, got.collect()), key=str) == rows and (fl == 10 or any(r[1] for r in rows) and any(r[2] for r in rows)), (m, fl)
        for ladder in (research.LADDER, ("m5", "m0")):
            want, got = research.cascade(one, ladder), research.cascade_sides(sides, ladder)
            assert want.columns == got.columns and sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
        sides.unpersist()
    sv.unpersist()


@pytest.mark.parametrize("name", ["events_all", "measurements"])
def test_flights_are_moved_once(spark, name):
    plan = plan_of(spark, name)
    assert samples(plan) == 1 and sum("REPARTITION_BY_NUM" in x for x in plan.splitlines()) == 1
    assert sum("FileScan" in x and "o_orderkey" in x for x in plan.splitlines()) == 1


def test_one_pass_gives_the_events_of_all_families_where_orders_share_a_key(spark, tmp_path):
    from aerolith.operators import events
    from aerolith.plans import event_queries as q

    orders = spark.read.parquet(f"{SF}/orders.parquet").filter("o_orderkey < 300").selectExpr("o_orderkey", "IF(o_orderkey % 41 = 0, NULL, o_custkey) AS o_custkey", "o_orderdate")
    shared = orders.filter("o_orderkey % 4 = 0").selectExpr("o_orderkey", "o_custkey + 3 AS o_custkey", "o_orderdate + INTERVAL 3 DAYS AS o_orderdate")
    nobody = orders.filter("o_orderkey = 7").selectExpr("CAST(NULL AS BIGINT) AS o_orderkey", "o_custkey", "o_orderdate")
    orders.unionByName(shared).unionByName(nobody).write.parquet(f"{tmp_path}/orders.parquet")
    spark.read.parquet(f"{SF}/nation.parquet").write.parquet(f"{tmp_path}/nation.parquet")
    want = events.assemble([events.track_events(q.progress(spark, tmp_path)), q._infra(spark, tmp_path)])
    got = q.all_events(spark, tmp_path)
    rows = sorted(map(str, got.select(want.columns).collect()))
    assert rows == sorted(map(str, want.collect())) and {"entry-runway", "exit-apron", "top-of-climb", "first_seen", "last-xing-fl100"} <= {r.type for r in got.select("type").distinct().collect()}
