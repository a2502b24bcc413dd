"""Other ways to name aerodromes, each giving (track_id, adep, ades), and their cascade."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import destination, flight_level_exact
from ..params import EndpointParams
from ..units import NM_PER_M
from .naming import classify_endpoints, side_by_side
from .spatial import endpoint_candidates, radius_join

#: The sets of airport types that methods are compared over.
AIRPORT_SETS = {
    "large": ["large_airport"],
    "large_medium": ["large_airport", "medium_airport"],
    "all_airports": ["large_airport", "medium_airport", "small_airport"],
    "with_heliports": ["large_airport", "medium_airport", "small_airport", "heliport"],
}
LADDER = ("m0", "m3", "m2", "m1", "m5")


def near(sv: DataFrame, airports: DataFrame, radius_nm: float = 30, max_fl: float | None = 40) -> DataFrame:
    """State vectors with each aerodrome within the radius; rows of unknown level stay."""
    rows = sv.dropna(subset=["lat", "lon", "track_id"])
    if max_fl is not None:
        rows = rows.filter(F.coalesce(flight_level_exact("baro_altitude") <= max_fl, F.lit(True)))
    return radius_join(rows, airports, radius_nm)


def _first(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def m0_trend(pairs: DataFrame, margin: int = 4) -> DataFrame:
    """By the trend of the trailing mean altitude near each aerodrome; the clearest trend wins, then the nearest aerodrome."""
    w = Window.partitionBy("track_id", "apt_ident").orderBy("event_time")
    rows = pairs.withColumn("_mean", F.avg("baro_altitude").over(w.rowsBetween(-4, 0)))
    rows = rows.withColumn("_change", F.col("_mean") - F.lag("_mean").over(w))
    up, down = F.sum(F.when(F.col("_change") > 0, 1).otherwise(0)), F.sum(F.when(F.col("_change") < 0, 1).otherwise(0))
    each = rows.groupBy("track_id", "apt_ident").agg((up - down).alias("trend"), F.min("dist_nm").alias("near_nm"))
    each = each.withColumn("role", F.when(F.col("trend") > margin, "adep").when(F.col("trend") < -margin, "ades")).filter("role IS NOT NULL")
    return side_by_side(_first(each, ["track_id", "role"], F.abs("trend").desc(), F.col("near_nm"), F.col("apt_ident")))


def m1_nearest(candidates: DataFrame) -> DataFrame:
    """The aerodrome nearest to each end."""
    return side_by_side(classify_endpoints(candidates, "nearest", EndpointParams(scheduled_penalty_nm=0)), "named")


def m2_on_ground(pairs: DataFrame) -> DataFrame:
    """The last surface row before the first airborne one, and the first after the last; each row at its nearest aerodrome."""
    rows = _first(pairs, ["track_id", "event_time", "lat", "lon"], F.col("dist_nm"), F.col("apt_ident"))
    whole = Window.partitionBy("track_id")
    air = F.when(~F.coalesce(F.col("on_ground"), F.lit(False)), F.col("event_time"))
    rows = rows.withColumns({"_first": F.min(air).over(whole), "_last": F.max(air).over(whole)}).filter("on_ground")
    by = F.struct("event_time", "lat", "lon")
    before = F.max_by(F.when(F.col("event_time") < F.col("_first"), F.col("apt_ident")), F.when(F.col("event_time") < F.col("_first"), by))
    after = F.min_by(F.when(F.col("event_time") > F.col("_last"), F.col("apt_ident")), F.when(F.col("event_time") > F.col("_last"), by))
    return rows.groupBy("track_id").agg(before.alias("adep"), after.alias("ades")).filter("adep IS NOT NULL OR ades IS NOT NULL")


def m3_vertical_rate(pairs: DataFrame, least_ms: float = 0.5) -> DataFrame:
    """By how many rows near each aerodrome climb or sink."""
    up = F.sum(F.when(F.col("vert_rate") > least_ms, 1).otherwise(0))
    down = F.sum(F.when(F.col("vert_rate") < -least_ms, 1).otherwise(0))
    each = pairs.groupBy("track_id", "apt_ident").agg((up - down).alias("score"), F.min("dist_nm").alias("near_nm"))
    each = each.withColumn("role", F.when(F.col("score") > 0, "adep").when(F.col("score") < 0, "ades")).filter("role IS NOT NULL")
    return side_by_side(_first(each, ["track_id", "role"], F.abs("score").desc(), F.col("near_nm"), F.col("apt_ident")))


def m5_lowest(pairs: DataFrame) -> DataFrame:
    """A track is halved in time; in each half the aerodrome at the lowest row, the nearest if several are as low."""
    whole = Window.partitionBy("track_id")
    t = F.unix_timestamp("event_time")
    rows = pairs.withColumn("_middle", (F.min(t).over(whole) + F.max(t).over(whole)) / 2)
    rows = rows.withColumn("role", F.when(t <= F.col("_middle"), "adep").otherwise("ades"))
    return side_by_side(_first(rows, ["track_id", "role"], F.col("baro_altitude").asc_nulls_last(), F.col("dist_nm"), F.col("apt_ident"), F.col("event_time")))


def m7_abstaining(candidates: DataFrame, radius_nm: tuple[float, float] = (20, 20), height_ft: tuple[float, float] = (15000, 15000)) -> DataFrame:
    """The nearest aerodrome of an end that is near and low, with limits for either side; else OOA at the border, else nothing."""
    sides = []
    for role, r, h in zip(("adep", "ades"), radius_nm, height_ft, strict=True):
        own = candidates.filter(F.col("role") == role)
        sides.append(classify_endpoints(own, "endpoint", EndpointParams(radius_nm=r, height_ft=h, scheduled_penalty_nm=0)))
    return side_by_side(sides[0].unionByName(sides[1]), "named")


def m8_extrapolated(sv: DataFrame, airports: DataFrame, radius_nm: float = 20, window_s: int = 300, reach_nm: float = 60) -> DataFrame:
    """Ends projected to the ground along the mean climb or descent of their last minutes, then matched again."""
    rows = sv.dropna(subset=["lat", "lon", "track_id"])
    whole, t = Window.partitionBy("track_id"), F.unix_timestamp("event_time")
    rows = rows.withColumns({"_t": t, "_t0": F.min(t).over(whole), "_t1": F.max(t).over(whole)})
    order = F.struct("event_time", "lat", "lon")
    row = F.struct("lat", "lon", "heading", "velocity", "baro_altitude")
    agg = rows.groupBy("track_id").agg(
        F.min_by(row, order).alias("a"), F.max_by(row, order).alias("z"),
        F.avg(F.when(F.col("_t") <= F.col("_t0") + window_s, F.col("vert_rate"))).alias("va"), F.avg(F.when(F.col("_t") >= F.col("_t1") - window_s, F.col("vert_rate"))).alias("vz"),
    )
    side = lambda role, e, rate, turn: F.struct(F.lit(role).alias("role"), F.col(e).alias("e"), rate.alias("rate"), F.lit(turn).alias("turn"))
    ends = agg.select("track_id", F.explode(F.array(side("adep", "a", F.col("va"), 180.0), side("ades", "z", -F.col("vz"), 0.0))).alias("x")).select("track_id", "x.role", "x.e.*", "x.rate", "x.turn")
    seconds_left = F.when(F.col("rate") > 0.5, F.greatest(F.col("baro_altitude"), F.lit(0.0)) / F.col("rate"))
    reach = F.least(F.coalesce(seconds_left * F.col("velocity") * NM_PER_M, F.lit(0.0)), F.lit(float(reach_nm)))
    there = ends.withColumn("_p", destination(F.col("lat"), F.col("lon"), F.coalesce(F.col("heading") + F.col("turn"), F.lit(0.0)), reach)).withColumns({"lat": F.col("_p.lat"), "lon": F.col("_p.lon")})
    pairs = radius_join(there.select("track_id", "role", "lat", "lon"), airports, radius_nm)
    return side_by_side(_first(pairs, ["track_id", "role"], F.col("dist_nm"), F.col("apt_ident")))


def cascade(methods: dict[str, DataFrame], ladder: tuple[str, ...] = LADDER) -> DataFrame:
    """(track_id, adep, ades, adep_by, ades_by): for either side the first method of the ladder that names one. One union and one aggregate, not a chain of full outer joins."""
    rows = None
    for k, name in enumerate(ladder):
        one = methods[name].select("track_id", "adep", "ades", F.lit(k).alias("k"), F.lit(name).alias("by"))
        rows = one if rows is None else rows.unionByName(one)
    pick = lambda side: F.min(F.when(F.col(side).isNotNull(), F.struct("k", F.col(side).alias("apt"), "by")))
    best = rows.groupBy("track_id").agg(pick("adep").alias("a"), pick("ades").alias("z"))
    return best.select("track_id", F.col("a.apt").alias("adep"), F.col("z.apt").alias("ades"), F.col("a.by").alias("adep_by"), F.col("z.by").alias("ades_by"))


def ladder_sides(sv: DataFrame, airports: DataFrame, radius_nm: float = 30, max_fl: float | None = 40, max_nm: float = 40, margin: int = 4, least_ms: float = 0.5) -> DataFrame:
    """(track_id, m0_adep, m0_ades, m1_adep ..): every method of the ladder in one pass, for every track that m1 has.

    Low rows and both ends of a track meet the aerodromes once; one aggregate by track and aerodrome and one by track, all from the partitioning that the tracks came with, give what
    m0_trend, m2_on_ground, m3_vertical_rate and m5_lowest find in near(), and m1_nearest in candidates_for(). Nothing is persisted, as nothing is read twice.
    """
    whole, at = Window.partitionBy("track_id"), F.struct("event_time", "lat", "lon")
    rows = sv.dropna(subset=["lat", "lon", "track_id"])
    rows = rows.withColumns({"_a": F.min(at).over(whole), "_z": F.max(at).over(whole), "_rows": F.count(F.lit(1)).over(whole)})
    low = F.lit(True) if max_fl is None else F.coalesce(flight_level_exact("baro_altitude") <= max_fl, F.lit(True))
    rows = rows.withColumns({"_begin": at == F.col("_a"), "_end": (at == F.col("_z")) & (F.col("_rows") > 1), "_low": low}).drop("_a", "_z", "_rows")
    rows = radius_join(rows.filter("_low OR _begin OR _end"), airports, max(radius_nm, max_nm), "left")
    rows = rows.withColumn("_pair", F.col("_low") & F.coalesce(F.col("dist_nm") <= radius_nm, F.lit(False))).filter("_pair OR _begin OR _end")

    own = Window.partitionBy("track_id", "apt_ident", "_pair").orderBy("event_time")  # what is no pair stands by itself
    rows = rows.withColumn("_mean", F.avg("baro_altitude").over(own.rowsBetween(-4, 0)))
    rows = rows.withColumn("_change", F.col("_mean") - F.lag("_mean").over(own))
    pair, ground, t = F.col("_pair"), F.coalesce(F.col("on_ground"), F.lit(False)), F.unix_timestamp("event_time")
    of_pairs = lambda f, c: f(F.when(pair, c)).over(whole)
    air = F.when(~ground, F.col("event_time"))
    rows = rows.withColumns({"_middle": (of_pairs(F.min, t) + of_pairs(F.max, t)) / 2, "_first": of_pairs(F.min, air), "_last": of_pairs(F.max, air)})

    net = lambda up, down: F.sum(F.when(pair & up, 1).when(pair & down, -1).otherwise(0))
    early, height = F.coalesce(t <= F.col("_middle"), F.lit(False)), F.struct(F.col("baro_altitude").isNull().alias("unknown"), "baro_altitude", "dist_nm")
    micros = F.unix_micros(F.col("event_time").cast("timestamp"))
    back, on = F.struct((-micros).alias("t"), (-F.col("lat")).alias("y"), (-F.col("lon")).alias("x"), "dist_nm"), F.struct(micros.alias("t"), F.col("lat").alias("y"), F.col("lon").alias("x"), "dist_nm")
    each = rows.groupBy("track_id", "apt_ident").agg(
        net(F.col("_change") > 0, F.col("_change") < 0).alias("trend"), net(F.col("vert_rate") > least_ms, F.col("vert_rate") < -least_ms).alias("score"), F.min(F.when(pair, F.col("dist_nm"))).alias("near_nm"),
        F.min(F.when(pair & ground & (F.col("event_time") < F.col("_first")), back)).alias("m2_adep"), F.min(F.when(pair & ground & (F.col("event_time") > F.col("_last")), on)).alias("m2_ades"),
        F.min(F.when(pair & early, height)).alias("m5_adep"), F.min(F.when(pair & ~early, height)).alias("m5_ades"),
        *[F.min(F.when(F.col(end) & (F.col("dist_nm") <= max_nm), F.struct("dist_nm"))).alias(c) for end, c in (("_begin", "m1_adep"), ("_end", "m1_ades"))],
    )
    least = lambda c, order: F.min(F.when(c, F.struct(order.alias("order"), "apt_ident")))["apt_ident"]
    clear = lambda c: F.struct((-F.abs(c)).alias("clear"), "near_nm")
    named = {}
    for m, sign, limit in (("m0", "trend", margin), ("m3", "score", 0)):
        named |= {f"{m}_adep": least(F.col(sign) > limit, clear(F.col(sign))), f"{m}_ades": least(F.col(sign) < -limit, clear(F.col(sign)))}
    named |= {c: least(F.col(c).isNotNull(), F.col(c)) for c in (f"{m}_{side}" for m in ("m1", "m2", "m5") for side in ("adep", "ades"))}
    return each.groupBy("track_id").agg(*[c.alias(name) for name, c in named.items()])


def cascade_sides(sides: DataFrame, ladder: tuple[str, ...] = LADDER, *also: str) -> DataFrame:
    """What cascade gives, from the methods side by side, with the columns named. Of a track without any aerodrome there is a row if m1, which has all tracks, is in the ladder."""
    rows = sides.select("track_id", *[x for s in ("adep", "ades") for x in (F.coalesce(*[F.col(f"{m}_{s}") for m in ladder]).alias(s), F.coalesce(*[F.when(F.col(f"{m}_{s}").isNotNull(), m) for m in ladder]).alias(f"{s}_by"))], *also)
    rows = rows if "m1" in ladder else rows.filter("adep IS NOT NULL OR ades IS NOT NULL")
    return rows.select("track_id", "adep", "ades", "adep_by", "ades_by", *also)


def only_aeroplanes(sv: DataFrame, aircraft: DataFrame, strict: bool = False) -> DataFrame:
    """sv without helicopters, gyroplanes, tilt-rotors and surface vehicles; airframes of unknown class stay. strict: landplanes and amphibians only."""
    kind = aircraft.groupBy("icao24").agg(F.min("icao_aircraft_class").alias("_class"))
    rows = sv.join(kind, "icao24", "left")
    first = F.substring("_class", 1, 1)
    wanted = F.coalesce(first.isin("L", "A"), F.lit(False)) if strict else ~F.coalesce(first.isin("H", "G", "T") | F.lower("_class").contains("surface"), F.lit(False))
    return rows.filter(wanted).drop("_class")


def candidates_for(sv: DataFrame, airports: DataFrame, max_nm: float = 40) -> DataFrame:
    """Candidates of every end, ends without any included."""
    return endpoint_candidates(sv, airports, max_nm, "left", EndpointParams(scheduled_penalty_nm=0))


def pivot_evidence(candidates: DataFrame) -> DataFrame:
    """The nearest candidate of either end side by side, with its evidence; a missing elevation counts as 0 and is marked."""
    best = classify_endpoints(candidates, "nearest", EndpointParams(scheduled_penalty_nm=0))
    cols = ["apt_ident", "dist_nm", "agl_ft", "elev_known", "on_ground", "at_border"]
    return best.groupBy("track_id").agg(*[F.max(F.when(F.col("role") == role, F.col(c))).alias(f"{role}_{c}") for role in ("adep", "ades") for c in cols])


