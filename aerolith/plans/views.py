"""Projections of the driver's tables into the domain, in Spark and, word for word the same, in SQL.

sv: raw state vectors from events. sm: smooth flights, 40 samples at 10 s for every order, with a hole, spikes, repeated values and repeated rows. apt:
aerodromes from nation. db: an aircraft registry from customer. truth: flights as known elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sv(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.expr
    return table(spark, sf_dir, "events").select(
        F.col("event_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        e("lower(lpad(hex(user_id), 6, '0'))").alias("icao24"),
        e("CASE WHEN user_id % 17 <> 0 THEN concat('C', user_id % 7) END").alias("callsign"),
        e("27 + (event_id * 7919 % 43000) / 1e3D").alias("lat"),
        e("-25 + (event_id * 104729 % 74000) / 1e3D").alias("lon"),
        e("CASE WHEN event_id % 13 <> 0 THEN CAST(event_id * 31 % 12000 AS DOUBLE) END").alias("baro_altitude"),
        e("CASE WHEN event_id % 13 <> 0 THEN CAST(event_id * 31 % 12000 + 50 AS DOUBLE) END").alias("geo_altitude"),
        F.col("value").alias("velocity"),
        e("CAST(event_id * 7 % 360 AS DOUBLE)").alias("heading"),
        e("CAST(event_id % 41 - 20 AS DOUBLE)").alias("vert_rate"),
        e("event_id % 11 = 0").alias("on_ground"),
        e("CAST(unix_timestamp(CAST(ts AS TIMESTAMP)) + event_id % 3 AS DOUBLE)").alias("last_contact"),
    )


SV = """sv AS (SELECT event_id, ts AS event_time, lower(lpad(to_hex(user_id), 6, '0')) AS icao24, CASE WHEN user_id % 17 <> 0 THEN 'C' || (user_id % 7) END AS callsign,
 27 + (event_id * 7919 % 43000) / 1e3 AS lat, -25 + (event_id * 104729 % 74000) / 1e3 AS lon,
 CASE WHEN event_id % 13 <> 0 THEN CAST(event_id * 31 % 12000 AS DOUBLE) END AS baro_altitude, CASE WHEN event_id % 13 <> 0 THEN CAST(event_id * 31 % 12000 + 50 AS DOUBLE) END AS geo_altitude,
 value AS velocity, CAST(event_id * 7 % 360 AS DOUBLE) AS heading, CAST(event_id % 41 - 20 AS DOUBLE) AS vert_rate, event_id % 11 = 0 AS on_ground,
 CAST(floor(epoch(ts)) + event_id % 3 AS DOUBLE) AS last_contact FROM events)"""

# One text for both engines: only integer arithmetic, CASE and double division.
_STEP = "CASE WHEN k % 13 = 5 THEN k - 1 ELSE k END"  # a repeated position
_SM_COLUMNS = f"""
 'T' || CAST(o_orderkey AS STRING) AS track_id, o_orderkey, k, o_custkey,
 lower(lpad(HEX(o_custkey), 6, '0')) AS icao24, CASE WHEN o_orderkey % 17 <> 0 THEN 'F' || CAST(o_orderkey AS STRING) END AS callsign,
 48 + (o_custkey % 5) * 0.4DBL + (o_orderkey % 10 - 5) * 0.01DBL + ((o_orderkey * 7) % 5 - o_custkey % 5) * 0.4DBL * ({_STEP}) / 39
   + CASE WHEN (k + o_orderkey) % 97 = 0 THEN 0.5DBL ELSE 0.0DBL END + dup * 0.001DBL AS lat,
 4 + (o_custkey % 25 - o_custkey % 5) / 5DBL * 0.5DBL + ((o_orderkey * 7) % 25 - (o_orderkey * 7) % 5 - (o_custkey % 25 - o_custkey % 5)) / 5DBL * 0.5DBL * ({_STEP}) / 39 AS lon,
 CASE WHEN k <= 12 THEN top * k / 12 WHEN k <= 26 THEN top ELSE top * (39 - k) / 12 END + CASE WHEN (k + o_orderkey) % 97 = 0 THEN 5000DBL ELSE 0DBL END AS baro_altitude,
 CASE WHEN k <= 12 THEN top * k / 12 WHEN k <= 26 THEN top ELSE top * (39 - k) / 12 END + 50DBL AS geo_altitude,
 CASE WHEN k % 13 = 5 THEN 60 + (k - 1) * 3DBL WHEN k <= 26 THEN 60 + k * 3DBL ELSE 138 - (k - 26) * 4DBL END AS velocity,
 CAST((o_orderkey * 11 + (CASE WHEN k % 13 = 5 THEN k - 1 ELSE k END) * 2) % 360 AS DOUBLE) AS heading,
 CASE WHEN k <= 12 THEN top / 120 WHEN k <= 26 THEN 0DBL ELSE 0 - top / 120 END AS vert_rate,
 (k = 0 OR k = 39) AND o_orderkey % 3 <> 0 AS on_ground"""


def _sm_text(engine: str) -> str:
    if engine == "spark":
        return _SM_COLUMNS.replace("DBL", "D").replace("HEX(", "hex(")
    import re

    text = re.sub(r"(\d+(?:\.\d+)?)DBL", r"CAST(\1 AS DOUBLE)", _SM_COLUMNS)
    return text.replace("AS STRING", "AS VARCHAR").replace("HEX(", "to_hex(")


#: Flights that one task expands to samples and sorts, about 0.2 GB of them.
_DEALT = 20_000


def dealt(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Those columns of orders with track_id, dealt by it: a flight is moved as the one row that it is, not as its samples, and all that goes on by track needs no other exchange.
    track_id is named on either side of the exchange, not moved."""
    orders = table(spark, sf_dir, "orders")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-orders.count() // _DEALT))
    track = F.expr("concat('T', CAST(o_orderkey AS STRING))")
    return orders.select(*columns).repartition(parts, track).select(*columns, track.alias("track_id"))


def sm(spark: SparkSession, sf_dir: str, **also: Column) -> DataFrame:
    """also: columns of a flight, made before it becomes samples; its samples carry them."""
    rows = dealt(spark, sf_dir, "o_orderkey", "o_custkey", "o_orderdate").select("*", *[c.alias(name) for name, c in also.items()])
    rows = rows.select(*also, "track_id", "o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp").alias("began"), F.expr("CAST(1500 + o_orderkey % 9 * 1000 AS DOUBLE)").alias("top"))
    rows = rows.withColumn("k", F.explode(F.expr("sequence(0L, 39L)")))
    rows = rows.withColumn("dup", F.explode(F.expr("sequence(0, CASE WHEN k % 19 = 3 THEN 1 ELSE 0 END)")))
    late = F.expr("k * 10 + CASE WHEN k > 20 THEN 400 ELSE 0 END")
    rows = rows.withColumn("event_time", F.timestamp_seconds(F.unix_timestamp("began") + late))
    given = [c for c in _split(_sm_text("spark")) if not c.endswith(" AS track_id")]
    return rows.select(*also, "event_time", "track_id", *[F.expr(x) for x in given], F.expr("CAST(unix_timestamp(event_time) + dup AS DOUBLE)").alias("last_contact"))


def _split(columns: str) -> list[str]:
    """The columns of a select list: commas outside brackets part them."""
    out, depth, now = [], 0, ""
    for c in columns:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(now.strip())
            now = ""
        else:
            now += c
    return [*out, now.strip()]


SM = f"""sm0 AS (SELECT o_orderkey, o_custkey, o_orderdate, CAST(1500 + o_orderkey % 9 * 1000 AS DOUBLE) AS top, unnest(range(0, 40)) AS k FROM orders),
sm1 AS (SELECT *, unnest(range(0, CASE WHEN k % 19 = 3 THEN 2 ELSE 1 END)) AS dup FROM sm0),
sm AS (SELECT o_orderdate + to_seconds(k * 10 + CASE WHEN k > 20 THEN 400 ELSE 0 END) AS event_time, {_sm_text("duckdb")},
 CAST(floor(epoch(o_orderdate + to_seconds(k * 10 + CASE WHEN k > 20 THEN 400 ELSE 0 END))) + dup AS DOUBLE) AS last_contact FROM sm1)"""


def apt(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.expr
    return table(spark, sf_dir, "nation").select(
        e("concat('A', n_nationkey)").alias("apt_ident"),
        e("48 + (n_nationkey % 5) * 0.4D").alias("apt_latitude_deg"),
        e("4 + (n_nationkey - n_nationkey % 5) / 5D * 0.5D").alias("apt_longitude_deg"),
        e("CASE WHEN n_nationkey % 8 <> 0 THEN CAST(n_nationkey * 37 AS DOUBLE) END").alias("elevation_ft"),
        e("CASE WHEN n_nationkey % 2 = 0 THEN 'yes' ELSE 'no' END").alias("apt_scheduled"),
        e("CASE WHEN n_nationkey % 3 = 0 THEN 'large_airport' WHEN n_nationkey % 3 = 1 THEN 'medium_airport' ELSE 'small_airport' END").alias("apt_type"),
    )


APT = """apt AS (SELECT 'A' || n_nationkey AS apt_ident, 48 + (n_nationkey % 5) * CAST(0.4 AS DOUBLE) AS apt_latitude_deg, 4 + (n_nationkey - n_nationkey % 5) / CAST(5 AS DOUBLE) * CAST(0.5 AS DOUBLE) AS apt_longitude_deg,
 CASE WHEN n_nationkey % 8 <> 0 THEN CAST(n_nationkey * 37 AS DOUBLE) END AS elevation_ft, CASE WHEN n_nationkey % 2 = 0 THEN 'yes' ELSE 'no' END AS apt_scheduled,
 CASE WHEN n_nationkey % 3 = 0 THEN 'large_airport' WHEN n_nationkey % 3 = 1 THEN 'medium_airport' ELSE 'small_airport' END AS apt_type FROM nation)"""


def db(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.expr
    return table(spark, sf_dir, "customer").select(
        e("concat(CASE WHEN c_custkey % 10 = 7 THEN 'x' ELSE '' END, lower(lpad(hex(c_custkey), 6, '0')))").alias("icao24"),
        e("concat('R-', c_custkey)").alias("registration"),
        e("concat('M', c_custkey % 12)").alias("model"),
        e("c_mktsegment").alias("typecode"),
        e("CASE c_custkey % 5 WHEN 0 THEN 'L2J' WHEN 1 THEN 'H1T' WHEN 2 THEN NULL WHEN 3 THEN 'A1P' ELSE 'G0E' END").alias("icao_aircraft_class"),
        e("concat('OP', c_nationkey)").alias("icao_operator"),
    )


DB = """db AS (SELECT CASE WHEN c_custkey % 10 = 7 THEN 'x' ELSE '' END || lower(lpad(to_hex(c_custkey), 6, '0')) AS icao24, 'R-' || c_custkey AS registration, 'M' || (c_custkey % 12) AS model, c_mktsegment AS typecode,
 CASE c_custkey % 5 WHEN 0 THEN 'L2J' WHEN 1 THEN 'H1T' WHEN 2 THEN NULL WHEN 3 THEN 'A1P' ELSE 'G0E' END AS icao_aircraft_class, 'OP' || c_nationkey AS icao_operator FROM customer)"""


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What another source knows of each flight: mostly the aerodromes it was drawn between."""
    e = F.expr
    return table(spark, sf_dir, "orders").select(
        e("lower(lpad(hex(o_custkey), 6, '0'))").alias("icao24"),
        e("concat('F', o_orderkey)").alias("callsign"),
        F.to_date(F.col("o_orderdate").cast("timestamp")).alias("day"),
        (F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) + F.expr("o_orderkey % 7 * 60")).alias("aobt_s"),
        e("CASE WHEN o_orderkey % 19 = 0 THEN 'ZZZZ' ELSE concat('A', o_custkey % 25) END").alias("adep"),
        e("CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE concat('A', o_orderkey * 7 % 25) END").alias("ades"),
    )


TRUTH = """truth AS (SELECT lower(lpad(to_hex(o_custkey), 6, '0')) AS icao24, 'F' || o_orderkey AS callsign, CAST(o_orderdate AS DATE) AS day, CAST(floor(epoch(o_orderdate)) AS BIGINT) + o_orderkey % 7 * 60 AS aobt_s,
 CASE WHEN o_orderkey % 19 = 0 THEN 'ZZZZ' ELSE 'A' || (o_custkey % 25) END AS adep, CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE 'A' || (o_orderkey * 7 % 25) END AS ades FROM orders)"""

VIEWS = {"sv": SV, "sm": SM, "apt": APT, "db": DB, "truth": TRUTH}


def angle_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """The central angle in SQL."""
    root = f"sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))"
    return f"(2 * asin(CASE WHEN {root} > 1 THEN 1 ELSE {root} END))"


def epoch_sql(t: str) -> str:
    return f"CAST(floor(epoch({t})) AS BIGINT)"
