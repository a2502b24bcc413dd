"""Scoring named aerodromes against another source, sweeps over limits, and the quality of tracks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import distance_nm, in_box
from ..params import Box


def identities(sv: DataFrame) -> DataFrame:
    """(track_id, icao24, callsign, day, t_start) of a track's first row, in the spelling of the other source."""
    order = F.struct("event_time", "icao24", "callsign")
    first = sv.groupBy("track_id").agg(F.min(order).alias("f"))
    return first.select("track_id", F.lower("f.icao24").alias("icao24"), F.trim("f.callsign").alias("callsign"), F.to_date("f.event_time").alias("day"), F.unix_timestamp("f.event_time").alias("t_start"))


#: Columns of the files of truth.
TRUTH_COLUMNS = ["AIRCRAFT_ADDRESS", "AIRCRAFT_ID", "ADEP", "ADES", "AOBT_3"]


def truth_flights(*months: DataFrame, days: list[str] | None = None) -> DataFrame:
    """(icao24, callsign, day, aobt_s, adep, ades): flights as the months' files of another source have them, airframes in lower case, callsigns trimmed. Flights without an airframe are left out; days keeps only those, so that a day of tracks is not held against a month of flights."""
    rows = None
    for m in months:
        one = m.select(F.lower("AIRCRAFT_ADDRESS").alias("icao24"), F.trim("AIRCRAFT_ID").alias("callsign"), F.to_date("AOBT_3").alias("day"), F.unix_timestamp(F.col("AOBT_3").cast("timestamp")).alias("aobt_s"), F.col("ADEP").alias("adep"), F.col("ADES").alias("ades"))
        rows = one if rows is None else rows.unionByName(one)
    rows = rows.filter("icao24 IS NOT NULL")
    return rows.filter(F.col("day").isin(*[F.to_date(F.lit(str(d))) for d in days])) if days else rows


def ratio(a: Column, b: Column, digits: int = 6) -> Column:
    return F.round(F.try_divide(a.cast("double"), b.cast("double")), digits)


def label_truth(truth: DataFrame, airports: DataFrame, box: Box = Box()) -> DataFrame:
    """truth with adep and ades replaced by OOA where the aerodrome is unknown or outside the box; a missing one stays NULL. The airports are joined once for both sides."""
    where = airports.select("apt_ident", in_box("apt_latitude_deg", "apt_longitude_deg", box).alias("inside"))
    rows = truth
    for side in ("adep", "ades"):
        rows = rows.join(where.select(F.col("apt_ident").alias(side), F.col("inside").alias(f"_{side}")), side, "left")
        rows = rows.withColumn(side, F.when(F.col(side).isNull() | F.coalesce(f"_{side}", F.lit(False)), F.col(side)).otherwise("OOA")).drop(f"_{side}")
    return rows.select(*truth.columns)


def align(truth: DataFrame, tracks: DataFrame) -> DataFrame:
    """Each flight of the other source with the track of its airframe, callsign and day that starts nearest to its off-block time; NULL if there is none."""
    t = truth.withColumnsRenamed({"adep": "true_adep", "ades": "true_ades"})
    rows = t.join(tracks, ["icao24", "callsign", "day"], "left")
    off = F.abs(F.col("t_start") - F.col("aobt_s"))
    w = Window.partitionBy("icao24", "callsign", "day", "aobt_s").orderBy(off.asc_nulls_last(), F.col("track_id").asc_nulls_last())
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def score(aligned: DataFrame, named: DataFrame) -> DataFrame:
    """One row: coverage, accuracy and overall rate of either side, out-of-area recall and precision, and the same within the area."""
    rows = aligned.join(named.select("track_id", "adep", "ades"), "track_id", "left")
    out = [F.count(F.lit(1)).alias("n"), F.count("track_id").alias("n_matched")]
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    for side in ("adep", "ades"):
        true, got = F.col(f"true_{side}"), F.col(side)
        known, given = true.isNotNull(), got.isNotNull()
        right = F.coalesce(true == got, F.lit(False))
        ooa, said = F.coalesce(true == "OOA", F.lit(False)), F.coalesce(got == "OOA", F.lit(False))
        inside = known & ~ooa
        out += [
            ratio(n(known & given), n(known)).alias(f"{side}_coverage"),
            ratio(n(right), n(known & given)).alias(f"{side}_accuracy"),
            ratio(n(right), n(known)).alias(f"{side}_overall"),
            ratio(n(ooa & said), n(ooa)).alias(f"{side}_ooa_recall"),
            ratio(n(ooa & said), n(said & known)).alias(f"{side}_ooa_precision"),
            ratio(n(inside & given & ~said), n(inside)).alias(f"{side}_inside_coverage"),
            ratio(n(inside & right), n(inside & given & ~said)).alias(f"{side}_inside_accuracy"),
        ]
    return rows.agg(*out)


def cascade_attribution(aligned: DataFrame, cascaded: DataFrame, ladder: tuple[str, ...], fallback: DataFrame | None = None) -> DataFrame:
    """For either side and rung of the cascade: how many it named, how many rightly, how many the fallback method would have got, its share and its lift over the fallback. Without a fallback, cascaded has its back_adep and back_ades."""
    rows = aligned.join(cascaded, "track_id")
    if fallback is not None:
        rows = rows.join(fallback.select("track_id", F.col("adep").alias("back_adep"), F.col("ades").alias("back_ades")), "track_id", "left")
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"{s}_by").alias("rung"), F.col(s).alias("got"), F.col(f"true_{s}").alias("true"), F.col(f"back_{s}").alias("back")) for s in ("adep", "ades")])
    rows = rows.select(F.explode(sides).alias("x")).select("x.*").filter(F.col("rung").isNotNull() & F.col("true").isNotNull())
    hit = lambda c: F.sum(F.when(F.col(c) == F.col("true"), 1).otherwise(0))
    each = rows.groupBy("side", "rung").agg(F.count(F.lit(1)).alias("n"), hit("got").alias("correct"), hit("back").alias("fallback_correct"))
    total = F.sum("n").over(Window.partitionBy("side"))
    place = F.coalesce(*[F.when(F.col("rung") == m, F.lit(k)) for k, m in enumerate(ladder)])
    return each.select("side", place.alias("place"), "rung", "n", "correct", "fallback_correct", ratio(F.col("n"), total).alias("share"), ratio(F.col("correct") - F.col("fallback_correct"), F.col("n")).alias("lift"))


def sweep(aligned: DataFrame, evidence: DataFrame, radii: list[float], heights: list[float]) -> DataFrame:
    """Coverage and accuracy for every pair of limits, from the nearest candidates' evidence: each row is met with the parameters inside the row, and one aggregate counts all pairs at once."""
    rows = aligned.join(evidence, "track_id", "left")
    grid = F.array(*[F.struct(F.lit(float(a)).alias("radius_nm"), F.lit(float(b)).alias("height_ft")) for a in radii for b in heights])
    rows = rows.withColumn("_p", F.explode(grid))
    aggs = []
    for side in ("adep", "ades"):
        low = F.col(f"{side}_on_ground") | (F.col(f"{side}_elev_known") & (F.col(f"{side}_agl_ft") <= F.col("_p.height_ft")))
        ok = F.coalesce((F.col(f"{side}_dist_nm") <= F.col("_p.radius_nm")) & low, F.lit(False))
        known = F.col(f"true_{side}").isNotNull()
        n = F.sum(F.when(ok & known, 1).otherwise(0))
        right = F.sum(F.when(ok & (F.col(f"true_{side}") == F.col(f"{side}_apt_ident")), 1).otherwise(0))
        aggs += [ratio(n, F.count(f"true_{side}")).alias(f"{side}_coverage"), ratio(right, n).alias(f"{side}_accuracy")]
    return rows.groupBy("_p.radius_nm", "_p.height_ft").agg(*aggs)


def penalty_sweep(aligned: DataFrame, candidates: DataFrame, penalties: list[float]) -> DataFrame:
    """Accuracy of the nearest aerodrome for several penalties of unscheduled aerodromes."""
    grid = F.array(*[F.lit(float(p)) for p in penalties])
    rows = candidates.withColumn("penalty_nm", F.explode(grid)).withColumn("_eff", F.col("dist_nm") + F.when(F.col("apt_scheduled") == "yes", 0.0).otherwise(F.col("penalty_nm")))
    best = rows.groupBy("track_id", "role", "penalty_nm").agg(F.min(F.struct(F.coalesce("_eff", F.lit(1e9)), "apt_ident")).alias("b"))
    named = best.groupBy("track_id", "penalty_nm").agg(*[F.max(F.when(F.col("role") == s, F.col("b.apt_ident"))).alias(s) for s in ("adep", "ades")])
    joined = aligned.join(named, "track_id")
    hit = lambda s: ratio(F.sum(F.when(F.col(s) == F.col(f"true_{s}"), 1).otherwise(0)), F.sum(F.when(F.col(s).isNotNull() & F.col(f"true_{s}").isNotNull(), 1).otherwise(0)))
    return joined.groupBy("penalty_nm").agg(hit("adep").alias("adep_accuracy"), hit("ades").alias("ades_accuracy"))


def per_airport(aligned: DataFrame, named: DataFrame) -> DataFrame:
    """For either side and aerodrome: true, named and rightly named flights, recall and ratio. One pass over both columns, not a join of two counts."""
    rows = aligned.join(named.select("track_id", "adep", "ades"), "track_id", "left")
    both = []
    for s in ("adep", "ades"):
        hit = F.when(F.col(s) == F.col(f"true_{s}"), 1).otherwise(0)
        both.append(F.struct(F.lit(s).alias("role"), F.col(f"true_{s}").alias("apt"), F.lit(1).alias("truth"), F.lit(0).alias("assigned"), hit.alias("correct")))
        both.append(F.struct(F.lit(s).alias("role"), F.col(s).alias("apt"), F.lit(0).alias("truth"), F.lit(1).alias("assigned"), F.lit(0).alias("correct")))
    rows = rows.select(F.explode(F.array(*both)).alias("x")).select("x.*").filter("apt IS NOT NULL")
    each = rows.groupBy("role", "apt").agg(F.sum("truth").alias("truth"), F.sum("assigned").alias("assigned"), F.sum("correct").alias("correct"))
    return each.filter("truth > 0").withColumns({"recall": ratio(F.col("correct"), F.col("truth")), "ratio": ratio(F.col("assigned"), F.col("truth"))})


def error_pairs(aligned: DataFrame, named: DataFrame, airports: DataFrame, top: int = 40) -> DataFrame:
    """The most frequent confusions of one aerodrome for another, how far apart they are, and whether a scheduled one was taken for one without service."""
    rows = aligned.join(named.select("track_id", "adep", "ades"), "track_id")
    sides = F.array(*[F.struct(F.lit(s).alias("role"), F.col(f"true_{s}").alias("true"), F.col(s).alias("got")) for s in ("adep", "ades")])
    rows = rows.select(F.explode(sides).alias("x")).select("x.*").filter(F.col("true") != F.col("got"))
    n = rows.groupBy("role", "true", "got").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "role", "true", "got").limit(top)
    at = lambda k: airports.select(F.col("apt_ident").alias(k), F.col("apt_latitude_deg").alias(f"{k}_lat"), F.col("apt_longitude_deg").alias(f"{k}_lon"), F.col("apt_scheduled").alias(f"{k}_s"))
    rows = n.join(at("true"), "true", "left").join(at("got"), "got", "left")
    apart = F.round(distance_nm("true_lat", "true_lon", "got_lat", "got_lon"), 6)
    return rows.select("role", "true", "got", "n", apart.alias("apart_nm"), ((F.col("true_s") == "yes") & (F.col("got_s") == "no")).alias("to_unscheduled"))


def track_summary(sv: DataFrame) -> DataFrame:
    t = F.unix_timestamp("event_time")
    return sv.groupBy("track_id").agg(F.min("icao24").alias("icao24"), F.min("callsign").alias("callsign"), F.count(F.lit(1)).alias("n"), F.min("event_time").alias("first_seen"), F.max("event_time").alias("last_seen"), ((F.max(t) - F.min(t)) / 3600).alias("hours"))


def track_quality(summary: DataFrame, edge_seconds: int = 300) -> DataFrame:
    """One row: tracks, callsigns that are missing, blank or padded, quantiles of length and duration, and tracks cut off at the edges of the time covered. Exact quantiles hold a count for each distinct value: rows of a track, and whole seconds, of which a month has 2.7 million."""
    ends = summary.agg(F.min("first_seen").alias("_from"), F.max("last_seen").alias("_to"))
    rows = summary.join(F.broadcast(ends))  # one row
    share = lambda c: F.round(F.avg(F.when(c, 1.0).otherwise(0.0)), 6)
    t = F.unix_timestamp
    return rows.agg(
        F.count(F.lit(1)).alias("tracks"),
        share(F.col("callsign").isNull()).alias("callsign_null"),
        share(F.trim("callsign") == "").alias("callsign_blank"),
        share(F.trim("callsign") != F.col("callsign")).alias("callsign_padded"),
        F.percentile("n", 0.5).alias("rows_p50"),
        F.percentile("n", 0.99).alias("rows_p99"),
        F.round(F.percentile("hours", 0.5), 6).alias("hours_p50"),
        F.round(F.percentile("hours", 0.99), 6).alias("hours_p99"),
        F.sum(F.when((t("first_seen") - t("_from") <= edge_seconds) | (t("_to") - t("last_seen") <= edge_seconds), 1).otherwise(0)).alias("at_edge"),
    )


def fragmentation(summary: DataFrame) -> DataFrame:
    """How many tracks each airframe, callsign and day falls into, counted by that number; many mean fragmented tracks."""
    each = summary.groupBy("icao24", "callsign", F.to_date("first_seen").alias("day")).agg(F.count(F.lit(1)).alias("tracks"))
    return each.groupBy("tracks").agg(F.count(F.lit(1)).alias("flights"))


def track_outliers(summary: DataFrame, first_day: str | None = None, last_day: str | None = None, edge_seconds: int = 300) -> DataFrame:
    """One row: tracks of a single row, of under 5 minutes and over 18 hours, the longest, and those that begin or end within edge_seconds of the days covered, which are those given or else those that the tracks reach."""
    days = summary.agg(F.coalesce(F.lit(first_day).cast("date"), F.to_date(F.min("first_seen"))).alias("_from"), F.coalesce(F.lit(last_day).cast("date"), F.to_date(F.max("last_seen"))).alias("_to"))
    rows = summary.join(F.broadcast(days))  # one row
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    t = lambda c: F.unix_timestamp(F.col(c).cast("timestamp"))
    return rows.agg(
        n(F.col("n") == 1).alias("single_row"),
        n(F.col("hours") < 5 / 60).alias("under_5min"),
        n(F.col("hours") > 18).alias("over_18h"),
        F.round(F.max("hours"), 6).alias("hours_max"),
        n(t("first_seen") - t("_from") < edge_seconds).alias("starts_at_edge"),
        n(t("_to") + 86399 - t("last_seen") < edge_seconds).alias("ends_at_edge"),
    )


def merging(truth: DataFrame, tracks: DataFrame) -> DataFrame:
    """One row: of the other source's flights those met by a track of their airframe, callsign and day, those met by several (fragmented), the 99th percentile and the most; of the tracks those met, those that meet several flights (merged), and the most. Flights are told apart by their aerodromes; rows that repeat one count as meetings of it.

    Both sides are counted by key before they meet, so that a key with many tracks and flights gives a row per flight, not per pair."""
    key = ["icao24", "callsign", "day"]
    flights = truth.groupBy(*key, "adep", "ades").agg(F.count(F.lit(1)).alias("_rows"))
    rows = flights.join(tracks.groupBy(*key).agg(F.count(F.lit(1)).alias("_tracks")), key)
    same = Window.partitionBy(*key)
    rows = rows.withColumns({"_met": F.col("_rows") * F.col("_tracks"), "_flights": F.sum("_rows").over(same), "_n": F.row_number().over(same.orderBy("adep", "ades"))})
    n = lambda c, of=1: F.coalesce(F.sum(F.when(c, of).otherwise(0)), F.lit(0))
    once = F.col("_n") == 1
    return rows.agg(
        F.count(F.lit(1)).alias("matched_flights"),
        n(F.col("_met") > 1).alias("fragmented_flights"),
        F.percentile("_met", 0.99).alias("tracks_per_flight_p99"),
        F.max("_met").alias("tracks_per_flight_max"),
        n(once, F.col("_tracks")).alias("matched_tracks"),
        n(once & (F.col("_flights") > 1), F.col("_tracks")).alias("merged_tracks"),
        F.max("_flights").alias("flights_per_track_max"),
    )
