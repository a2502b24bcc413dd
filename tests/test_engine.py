"""Sources, tables, ledgers, the steps end to end, the command line and the stream."""

import json
from dataclasses import replace
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from aerolith import schemas
from aerolith.config import Config, load_env
from aerolith.operators import export
from aerolith.plans import calendar, runner
from aerolith.plans.drivers import Steps
from aerolith.sources import readers
from aerolith.sources.store import Ledger, Store, emit, write_many
from aerolith.streaming import ingest

T0 = datetime(2024, 6, 1, 12, tzinfo=timezone.utc)


def test_ranges_are_half_open():
    assert [m.isoformat() for m in calendar.months(date(2024, 1, 15), date(2024, 3, 1))] == ["2024-01-01", "2024-02-01"]
    assert calendar.bounds(date(2024, 12, 5)) == (datetime(2024, 12, 1, tzinfo=timezone.utc), datetime(2025, 1, 1, tzinfo=timezone.utc))
    assert calendar.intervals(date(2024, 1, 1), date(2024, 1, 12), 10) == [(date(2024, 1, 1), date(2024, 1, 10)), (date(2024, 1, 11), date(2024, 1, 12))]
    assert export.day_intervals(date(2024, 1, 1), date(2024, 1, 12)) == [(date(2024, 1, 1), date(2024, 1, 11)), (date(2024, 1, 11), date(2024, 1, 12))]
    assert export.month_intervals(date(2024, 1, 15), date(2024, 2, 2)) == [(date(2024, 1, 1), date(2024, 2, 1)), (date(2024, 2, 1), date(2024, 3, 1))]
    assert export.month_intervals(date(2024, 2, 1), date(2024, 2, 1)) == []
    assert export.last_months(date(2020, 1, 1), date(2024, 6, 1), 2, date(2024, 6, 15)) == (date(2024, 4, 1), date(2024, 6, 1))
    assert readers.hour_paths("/x", T0, T0 + timedelta(hours=2)) == ["/x/hour=1717243200", "/x/hour=1717246800"]


def test_filters_run_on_raw_seconds(spark):
    df = spark.createDataFrame([(10, 50.0, 4.0), (11, 50.0, 4.0), (15, 50.0, 80.0), (20, None, 4.0)], "event_time long, lat double, lon double")
    assert [r.event_time for r in readers.decimate(df).collect()] == [10]
    assert readers.decimate(df, None, 1).count() == 4


def test_schemas_are_merged_and_renamed(spark, tmp_path):
    spark.createDataFrame([(10, 50.0, 4.0, True)], "time long, lat double, lon double, onGround boolean").write.parquet(f"{tmp_path}/a")
    spark.createDataFrame([(15, 51.0, 5.0, 7.5)], "time long, lat double, lon double, velocity double").write.parquet(f"{tmp_path}/b")
    df = readers.state_vectors(spark, f"{tmp_path}/a", f"{tmp_path}/b")
    assert df.schema.names == schemas.STATE_VECTORS.names and df.schema["event_time"].dataType.typeName() == "timestamp"
    assert {(r.lat, r.on_ground, r.velocity) for r in df.collect()} == {(50.0, True, None), (51.0, None, 7.5)}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(lat" in plan


def test_csv_sources(spark, tmp_path):
    (tmp_path / "db.csv").write_text("'icao24','registration','model','typecode','icaoAircraftClass','operatorIcao','x'\n'abc','R 1 ','','  ','L2J','OP','y'\n")
    row = readers.aircraft_db(spark, f"{tmp_path}/db.csv").first()
    assert (row.icao24, row.registration, row.model, row.typecode) == ("abc", "R 1", None, "")
    assert readers.aircraft(readers.aircraft_db(spark, f"{tmp_path}/db.csv"), "ABC")["icao_operator"] == "OP"
    assert readers.aircraft(readers.aircraft_db(spark, f"{tmp_path}/db.csv"), "zzz") is None
    (tmp_path / "regions.csv").write_text('id,code,local_code,name\n1,A,,"x, y"\nnone,B,b,z\n')
    rows = readers.reference_csv(spark, f"{tmp_path}/regions.csv", "regions").collect()
    assert [(r.id, r.name, r.keywords) for r in rows] == [(1, "x, y", None), (None, "z", None)]


def test_store_modes(spark, tmp_path):
    s = Store(spark, str(tmp_path))
    df = lambda *rows: spark.createDataFrame(list(rows), "day string, x int")
    assert not s.exists("t")
    s.write(df(("a", 1), ("b", 2)), "t", "overwrite", ["day"])
    s.write(df(("b", 3)), "t", "insert_overwrite", ["day"])
    assert sorted((r.day, r.x) for r in s.read("t").collect()) == [("a", 1), ("b", 3)]
    s.write(df(("b", 4)), "t", "append", ["day"])
    assert spark.sql(f"SELECT count(*) AS n FROM {s.view('t')}").first().n == 3
    s.write(df(("c", 9)), "t", "overwrite", ["day"])
    assert spark.sql(f"SELECT max(x) AS n FROM {s.view('t')}").first().n == 9
    assert s.complete("t")
    with pytest.raises(ValueError):
        s.write(df(), "t", "merge")


def test_catalog_store(spark):
    s = Store(spark)
    df = lambda *rows: spark.createDataFrame(list(rows), "x int, day string")
    s.write(df((1, "a"), (2, "b")), "cat_t", "overwrite", ["day"])
    s.write(df((3, "b")), "cat_t", "insert_overwrite", ["day"])
    assert sorted((r.x, r.day) for r in s.read("cat_t").collect()) == [(1, "a"), (3, "b")]
    spark.sql("DROP TABLE cat_t")
    assert not s.exists("cat_t")
    with pytest.raises(FileNotFoundError):
        readers.with_fallback(spark, s, "cat_t", "/no/such/path")


def test_ledger(spark, tmp_path):
    ledger = Ledger(Store(spark, str(tmp_path)))
    assert ledger.left("a", ["1", "2"]) == ["1", "2"]
    ledger.mark("a", "1")
    ledger.mark("b", "2")
    assert ledger.left("a", ["1", "2"]) == ["2"] and ledger.left("a", ["1", "2"], skip_done=False) == ["1", "2"]


def flight(k, base, to, callsign="F1", icao="aaa111"):
    """A climb from base, a cruise, and a descent to another place: 80 samples at 15 s."""
    out = []
    for i in range(80):
        share = i / 79
        alt = min(i, 79 - i, 25) * 130.0
        rate = 8.7 if i < 25 else -8.7 if i > 54 else 0.0
        out.append((T0 + timedelta(hours=3 * k, seconds=15 * i), icao, base[0] + (to[0] - base[0]) * share, base[1] + (to[1] - base[1]) * share, 5.0 if i in (0, 79) else 130.0, 90.0, rate if 0 < i < 79 else 0.0, callsign, i in (0, 79), False, False, None, alt, alt, 0.0, float(i), [1]))
    return out


def test_steps_end_to_end(spark, tmp_path):
    config = replace(Config.for_environment("local", f"{tmp_path}/w"), raw=f"{tmp_path}/raw", every_s=1)
    steps = Steps(Store(spark, config.root), config)
    raw = spark.createDataFrame(flight(0, (50.0, 4.0), (50.6, 4.9)) + flight(1, (50.6, 4.9), (50.0, 4.0), "F2", "bbb222"), schemas.STATE_VECTORS)
    raw = raw.withColumn("event_time", F.unix_timestamp("event_time"))
    for hour in (12, 15):
        unix = int(T0.replace(hour=hour).timestamp())
        raw.filter(F.floor(F.col("event_time") / 3600) * 3600 == unix).write.parquet(f"{tmp_path}/raw/hour={unix}")
    (tmp_path / "airports.csv").write_text("id,ident,type,name,latitude_deg,longitude_deg,elevation_ft,continent,scheduled_service\n1,AAAA,large_airport,a,50.0,4.0,0,EU,yes\n2,BBBB,medium_airport,b,50.6,4.9,100,EU,no\n3,SSSS,small_airport,s,50.3,4.4,0,EU,no\n")
    (tmp_path / "db.csv").write_text("'icao24','registration','model','typecode','icaoAircraftClass','operatorIcao'\n'aaa111','R1','M','T','L2J','O'\n")
    assert steps.reference({"airports": f"{tmp_path}/airports.csv"}) == {"airports": 3}
    steps.aircraft(f"{tmp_path}/db.csv")
    steps.zones(7, (0, 5, 10))
    assert steps.ingest(T0, T0 + timedelta(hours=6)) == 160
    assert steps.ingest(T0, T0 + timedelta(hours=6)) == 160  # replaces its days
    month = (date(2024, 6, 1), date(2024, 7, 1))
    assert steps.tracks(*month) == ["2024-06-01"] and steps.tracks(*month) == []
    assert set(schemas.TRACKS.names) <= set(steps.store.read("tracks").columns)
    assert steps.clean(*month)["2024-06-01"]["lat"] < 0.1
    assert steps.flights(*month) == ["2024-06-01"]
    got = {r.FLT_ID: (r.ADEP, r.ADES, r.REGISTRATION) for r in steps.store.read("flight_list").collect()}
    assert got == {"F1": ("AAAA", "BBBB", "R1"), "F2": ("BBBB", "AAAA", None)}
    assert steps.overflights(*month) == ["2024-06-01"] and steps.store.read("flight_list").count() == 2
    ring = F.array(*[F.struct(F.lit(a).alias("lat"), F.lit(b).alias("lon")) for a, b in ((49.99, 3.99), (49.99, 4.02), (50.02, 4.02), (50.02, 3.99), (49.99, 3.99))])
    features = spark.createDataFrame([("AAAA", 5, "runway", "09", "asphalt", None, "2 mi", "way")], "apt_icao string, osm_id long, aeroway string, ref string, surface string, width string, length string, type string").withColumn("ring", ring)
    assert steps.events(*month, families=("infrastructure",)) == [] and steps.ledger.left("events-infrastructure", ["2024-06-01"])  # no layouts yet: not done, not marked
    steps.layouts(features)
    line = features.drop("ring").withColumns({"apt_icao": F.lit("BBBB"), "line": F.array(F.struct(F.lit(50.6).alias("lat"), F.lit(4.9).alias("lon")), F.struct(F.lit(50.61).alias("lat"), F.lit(4.9).alias("lon")))})
    steps.layouts(line)
    assert {r.layout_apt_icao for r in steps.store.read("layouts").select("layout_apt_icao").distinct().collect()} == {"AAAA", "BBBB"} == steps.ledger.done("layouts")
    assert steps.events(*month, families=("horizontal", "vertical", "seen")) == ["2024-06-01"]
    assert steps.events(*month) == ["2024-06-01"] and steps.events(*month) == []
    kinds = {r.type for r in steps.store.read("flight_events").select("type").distinct().collect()}
    assert {"first_seen", "last_seen", "first-xing-fl50", "last-xing-fl100", "take-off", "entry-runway", "exit-runway"} <= kinds
    assert steps.store.read("measurements").count() == 2 * steps.store.read("flight_events").count()
    stored = lambda name: sorted(map(str, steps.store.read(name).collect()))
    events, values = stored("flight_events"), stored("measurements")
    assert steps.events(*month, skip_done=False) == ["2024-06-01"]  # a redo leaves the same tables
    assert stored("flight_events") == events and stored("measurements") == values and len(set(events)) == len(events)
    write, calls = steps.store.write, []
    steps.store.write = lambda df, name, *a: calls.append(name) or (write(df, name, *a) if name != "measurements" else 1 / 0)
    with pytest.raises(ZeroDivisionError):  # between the two writes
        steps.events(*month, skip_done=False)
    steps.store.write = write
    assert calls == ["flight_events", "measurements"] and steps.events(*month, skip_done=False) and stored("flight_events") == events and stored("measurements") == values
    out = steps.export(*month, f"{tmp_path}/export")
    assert out["flight_list"] == 2 and out["measurements"] == 2 * out["flight_events"] > 0
    assert steps.export(*month, f"{tmp_path}/export") == {"flight_list": 0, "flight_events": 0, "measurements": 0}
    assert steps.clean_copies(f"{tmp_path}/export", f"{tmp_path}/copies") == 3
    assert spark.read.csv(f"{tmp_path}/copies/flight_list.csv", header=True).count() == 2
    counts = steps.counts()
    assert counts["tracks"] == 160 and counts["flight_list"] == 2
    assert steps.report(f"{tmp_path}/report").first().explanation.startswith("Low count (160)")
    other = Steps(steps.store, replace(config, mode="endpoint"))
    other.store = steps.store
    assert other.flights(*month) == ["2024-06-01"]
    got = {r.FLT_ID: (r.ADEP, r.ADES) for r in steps.store.read("flight_list").filter("VERSION = 'v3.0.0'").collect()}
    assert got == {"F1": ("AAAA", "BBBB"), "F2": ("BBBB", "AAAA")}


def test_redo_of_flights_keeps_overflights(spark, tmp_path):
    config = replace(Config.for_environment("local", f"{tmp_path}/w"), raw=f"{tmp_path}/raw", every_s=1)
    steps = Steps(Store(spark, config.root), config)
    rows = flight(0, (50.0, 4.0), (50.6, 4.9)) + [(*r[:12], 11000.0, 11000.0, *r[14:]) for r in flight(1, (52.0, 8.0), (53.0, 9.0), "OVER", "ccc333")]
    raw = spark.createDataFrame([(*r[:8], False, *r[9:]) if r[7] == "OVER" else r for r in rows], schemas.STATE_VECTORS).withColumn("event_time", F.unix_timestamp("event_time"))
    for hour in (12, 15):
        unix = int(T0.replace(hour=hour).timestamp())
        raw.filter(F.floor(F.col("event_time") / 3600) * 3600 == unix).write.parquet(f"{tmp_path}/raw/hour={unix}")
    (tmp_path / "airports.csv").write_text("id,ident,type,name,latitude_deg,longitude_deg,elevation_ft,continent,scheduled_service\n1,AAAA,large_airport,a,50.0,4.0,0,EU,yes\n2,BBBB,medium_airport,b,50.6,4.9,100,EU,no\n")
    (tmp_path / "db.csv").write_text("'icao24','registration','model','typecode','icaoAircraftClass','operatorIcao'\n'aaa111','R1','M','T','L2J','O'\n")
    steps.reference({"airports": f"{tmp_path}/airports.csv"})
    steps.aircraft(f"{tmp_path}/db.csv")
    steps.zones(7, (0, 5, 10))
    steps.ingest(T0, T0 + timedelta(hours=6))
    month = (date(2024, 6, 1), date(2024, 7, 1))
    steps.tracks(*month)
    steps.clean(*month)
    assert steps.flights(*month) == steps.overflights(*month) == ["2024-06-01"]
    once = sorted(map(str, steps.store.read("flight_list").collect()))
    assert len(once) == 2
    steps.flights(*month, skip_done=False)
    assert sorted(map(str, steps.store.read("flight_list").collect())) == once
    steps.overflights(*month, skip_done=False)
    assert sorted(map(str, steps.store.read("flight_list").collect())) == once


def test_nobodys_rows_are_parted_by_the_hour(spark):
    from aerolith.operators.sessionize import track_ids

    rows = spark.createDataFrame([(None, None, T0 + timedelta(minutes=20 * k), 9000.0) for k in range(9)] + [(None, "X", T0 + timedelta(minutes=20 * k), 9000.0) for k in range(9)], "icao24 string, callsign string, event_time timestamp, baro_altitude double")
    got = track_ids(rows)
    assert got.filter("callsign IS NULL").select("track_id").distinct().count() == 3 and got.filter("callsign = 'X'").select("track_id").distinct().count() == 1


def test_steps_and_command_line(capsys):
    assert list(runner.STEPS)[:5] == ["00a", "00b", "00c", "00d", "00e"]
    assert runner.chosen(["02"]) == ["02"] and runner.chosen(["00"]) == ["00a", "00b", "00c", "00d", "00e"] and runner.chosen(None) == list(runner.STEPS)
    assert runner.main(["steps"]) == 0 and "02a clean tracks" in capsys.readouterr().out


def test_score_and_sweep_from_the_command_line(spark, tmp_path, monkeypatch):
    from aerolith.plans import study

    columns = [f.name for f in schemas.STATE_VECTORS.fields]
    for k, name, icao, a, b in ((0, "F1", "aaa111", (50.0, 4.0), (50.6, 4.9)), (1, "F2", "bbb222", (50.6, 4.9), (50.0, 4.0))):
        spark.createDataFrame(flight(k, a, b, name, icao), schemas.STATE_VECTORS).select(*columns).withColumn("track_id", F.lit(name)).write.mode("append").parquet(f"{tmp_path}/tracks")
    airports = [("AAAA", 50.0, 4.0, 0.0, "yes", "large_airport"), ("BBBB", 50.6, 4.9, 100.0, "no", "medium_airport"), ("SSSS", 50.0, 4.01, 0.0, "no", "small_airport")]
    spark.createDataFrame(airports, "apt_ident string, apt_latitude_deg double, apt_longitude_deg double, elevation_ft double, apt_scheduled string, apt_type string").write.parquet(f"{tmp_path}/airports")
    truth = "AIRCRAFT_ADDRESS string, AIRCRAFT_ID string, ADEP string, ADES string, AOBT_3 timestamp"
    spark.createDataFrame([("AAA111", " F1 ", "AAAA", "BBBB", T0), (None, "F9", "AAAA", "BBBB", T0)], truth).write.parquet(f"{tmp_path}/june")
    spark.createDataFrame([("bbb222", "F2", "BBBB", "XXXX", T0 + timedelta(hours=3)), ("BBB222", "F2", "BBBB", "AAAA", T0 + timedelta(days=3))], truth).write.parquet(f"{tmp_path}/other")
    monkeypatch.setattr(runner, "session", lambda config: spark)
    files = ["--tracks", f"{tmp_path}/tracks", "--airports", f"{tmp_path}/airports", "--truth", f"{tmp_path}/june", f"{tmp_path}/other", "--days", "2024-06-01", "--out", f"{tmp_path}/out"]
    assert runner.main(["score", *files, "--methods", "m1", "m6"]) == 0 and runner.main(["sweep", *files]) == 0
    rows = {r.method: r for r in spark.read.csv(f"{tmp_path}/out/score", header=True).collect()}
    assert set(rows) == {"m1", "m6"} and (rows["m1"].n, rows["m1"].n_matched, rows["m1"].adep_accuracy, rows["m1"].ades_accuracy) == ("2", "2", "1.0", "0.5")
    assert spark.read.csv(f"{tmp_path}/out/sweep", header=True).count() == len(study.SWEEP_RADII) * len(study.SWEEP_HEIGHTS)
    with pytest.raises(SystemExit):
        runner.main(["score"])
    with pytest.raises(ValueError):
        study.name_by(spark.read.parquet(f"{tmp_path}/tracks"), spark.read.parquet(f"{tmp_path}/airports"), ["m4"])


def test_configuration(tmp_path, monkeypatch):
    assert Config.for_environment("live").cluster.options()["spark.sql.adaptive.enabled"] == "true"
    with pytest.raises(ValueError):
        Config.for_environment("moon")
    monkeypatch.setenv("AEROLITH_A", "kept")
    (tmp_path / ".env").write_text("# x\nAEROLITH_A=1\nAEROLITH_B='2'\n")
    assert load_env(str(tmp_path / "none"), str(tmp_path / ".env")) == {"AEROLITH_A": "1", "AEROLITH_B": "2"}
    import os

    assert os.environ["AEROLITH_A"] == "kept" and os.environ.pop("AEROLITH_B") == "2"


def test_stream_reads_each_file_once(spark, tmp_path):
    raw = spark.createDataFrame([(10, 50.0, 4.0)], "time long, lat double, lon double")
    raw.write.parquet(f"{tmp_path}/in/a")
    run = lambda: ingest.append_by_day(ingest.file_stream(spark, f"{tmp_path}/in", raw.schema), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination(60)
    assert run() and run()
    raw.write.parquet(f"{tmp_path}/in/b")
    assert run()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2


def test_every_query_has_sql_and_no_python(spark):
    from aerolith.plans.queries import QUERIES, SQL

    assert set(QUERIES) == set(SQL)
    for name in ("clean_segment", "flights_trend", "events_all", "track_summary", "zone_rings"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan, name


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert json.dumps(sorted(__spark_entry__.oracle_sql()))


def test_many_folders_and_one_file(spark, tmp_path):
    df = spark.range(10).repartition(3)
    write_many(df, [f"{tmp_path}/a", f"{tmp_path}/b"])
    assert spark.read.parquet(f"{tmp_path}/b").count() == 10
    emit(df, f"{tmp_path}/c", "csv")
    emit(df, f"{tmp_path}/d")
    assert len(list((tmp_path / "c").glob("part-*"))) == 1 and len(list((tmp_path / "d").glob("part-*.parquet"))) == 1
