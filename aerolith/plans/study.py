"""Methods of naming aerodromes held against another source, from files: what the command line's score and sweep run."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, research, score
from ..params import Box
from ..sources.store import emit

#: Limits that a sweep tries, NM and feet above the aerodrome.
SWEEP_RADII = [1, 2, 3, 5, 10, 20, 40, 80, 110]
SWEEP_HEIGHTS = [0, 500, 1000, 2000, 5000, 8000, 10000, 15000, 20000, 1e9]


def name_by(sv: DataFrame, airports: DataFrame, methods: list[str], radius_nm: float = 30, max_fl: float = 40) -> dict[str, DataFrame]:
    """(track_id, adep, ades) of each method; m6 is the cascade of the others."""
    pairs, candidates = research.near(sv, airports, radius_nm, max_fl), research.candidates_for(sv, airports)
    make = {
        "m0": lambda: research.m0_trend(pairs),
        "m1": lambda: research.m1_nearest(candidates),
        "m2": lambda: research.m2_on_ground(pairs),
        "m3": lambda: research.m3_vertical_rate(pairs),
        "m5": lambda: research.m5_lowest(pairs),
        "m6": lambda: research.cascade({m: make[m]() for m in research.LADDER}),
        "m7": lambda: research.m7_abstaining(candidates),
        "m8": lambda: research.m8_extrapolated(sv, airports),
    }
    unknown = set(methods) - set(make)
    if unknown:
        raise ValueError(f"unknown methods {sorted(unknown)}; known are {sorted(make)}")
    return {m: make[m]() for m in methods}


def inputs(spark: SparkSession, tracks: str, airports: str, truth: list[str], days: list[str] | None, airport_set: str, aircraft: str | None = None, strict: bool = False, box: Box = Box()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(state vectors of tracks, aerodromes of the set, truth aligned with the tracks), of Parquet files. Truth is held to the days, the tracks to aeroplanes if there is a registry."""
    sv = clean.drop_duplicates(spark.read.parquet(tracks))
    if aircraft:
        sv = research.only_aeroplanes(sv, spark.read.parquet(aircraft), strict)
    known = spark.read.parquet(airports)
    flights = score.label_truth(score.truth_flights(*[spark.read.parquet(p) for p in truth], days=days), known, box)
    return sv, known.filter(F.col("apt_type").isin(*research.AIRPORT_SETS[airport_set])), score.align(flights, score.identities(sv))


def scores(sv: DataFrame, airports: DataFrame, aligned: DataFrame, methods: list[str]) -> DataFrame:
    """A row for each method: see score.score."""
    rows = None
    for name, named in name_by(sv, airports, methods).items():
        one = score.score(aligned, named).withColumn("method", F.lit(name))
        rows = one if rows is None else rows.unionByName(one)
    return rows


def swept(sv: DataFrame, airports: DataFrame, aligned: DataFrame) -> DataFrame:
    """A row for each pair of limits: see score.sweep."""
    evidence = research.pivot_evidence(research.candidates_for(sv, airports, max(SWEEP_RADII)))
    return score.sweep(aligned, evidence, SWEEP_RADII, SWEEP_HEIGHTS)


def add_arguments(p: argparse.ArgumentParser) -> None:
    p.add_argument("--tracks", metavar="PARQUET", help="score, sweep: state vectors with track_id")
    p.add_argument("--airports", metavar="PARQUET", help="score, sweep: aerodromes")
    p.add_argument("--truth", nargs="*", default=[], metavar="PARQUET", help="score, sweep: flights of the other source, a file a month")
    p.add_argument("--days", nargs="*", metavar="DAY", help="score, sweep: days of the tracks")
    p.add_argument("--methods", nargs="*", default=["m1", "m7"], help="score: m0 to m8")
    p.add_argument("--airport-set", default="large_medium", choices=list(research.AIRPORT_SETS))
    p.add_argument("--registry", metavar="PARQUET", help="score, sweep: aircraft, to leave out what is no aeroplane")
    p.add_argument("--strict-aircraft", action="store_true")
    p.add_argument("--out", default="results", help="score, sweep: folder of the results")


def run(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """The result, also written as one CSV file."""
    sv, airports, aligned = inputs(spark, args.tracks, args.airports, args.truth, args.days, args.airport_set, args.registry, args.strict_aircraft)
    rows = scores(sv, airports, aligned, args.methods) if args.command == "score" else swept(sv, airports, aligned)
    emit(rows, f"{args.out}/{args.command}", "csv")
    return rows
