import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"  # for Python workers


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    shared = tempfile.mkdtemp(prefix="aerolith-tests-")
    s = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "3g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{shared}/checkpoints")
        .config("spark.sql.warehouse.dir", f"{shared}/warehouse")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


EPOCH = 1717243200  # 2024-06-01 12:00:00 UTC
TRACK = "event_time timestamp, track_id string, icao24 string, lat double, lon double, baro_altitude double, geo_altitude double, velocity double, heading double, vert_rate double, on_ground boolean, last_contact double"


@pytest.fixture
def track(spark):
    """Builds a track from samples that name only what deviates; t is in seconds."""
    from datetime import datetime, timezone

    def make(samples):
        rows = []
        for k, s in enumerate(samples):
            t = s.get("t", k)
            d = {"event_time": datetime.fromtimestamp(EPOCH + t, timezone.utc), "track_id": "trk-1", "icao24": "abc123", "lat": 50.0, "lon": 4.0, "baro_altitude": 10000.0, "geo_altitude": 10000.0, "velocity": 200.0, "heading": 90.0, "vert_rate": 0.0, "on_ground": False, "last_contact": float(t)}
            d |= {c: v for c, v in s.items() if c != "t"}
            rows.append(tuple(d[c.split()[0]] for c in TRACK.split(", ")))
        return spark.createDataFrame(rows, TRACK)

    return make


@pytest.fixture
def values():
    def of(df, column):
        return [r[column] for r in df.orderBy("event_time").select(column).collect()]

    return of
