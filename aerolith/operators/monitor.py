"""Row counts by day, their gaps, known outages and suspicious days."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A day with fewer rows is suspicious.
LEAST_ROWS = 25_000_000
#: Known outages of the feed.
OUTAGES = [
    ("2023-01-02 23:00:00", "2023-01-03 10:00:00"),
    ("2023-01-18 11:00:00", "2023-01-23 07:00:00"),
    ("2023-06-21 13:00:00", "2023-06-21 22:00:00"),
    ("2023-11-15 06:00:00", "2023-11-16 08:00:00"),
    ("2023-11-20 01:00:00", "2023-11-20 03:00:00"),
    ("2023-12-02 08:00:00", "2023-12-05 03:00:00"),
    ("2024-05-20 10:00:00", "2024-05-21 05:00:00"),
]


def table_counts(frames: dict[str, DataFrame | None]) -> dict[str, int]:
    """Rows of each table; -1 where it cannot be read."""
    out = {}
    for name, df in frames.items():
        try:
            out[name] = -1 if df is None else df.count()
        except Exception:
            out[name] = -1
    return out


def daily_counts(df: DataFrame, time: str) -> DataFrame:
    return df.groupBy(F.to_date(time).alias("day")).agg(F.count(F.lit(1)).alias("n"))


def fill_days(counts: DataFrame) -> DataFrame:
    """A row for every day from the first to the last; days without rows count 0."""
    days = counts.agg(F.min("day").alias("a"), F.max("day").alias("b")).filter("a IS NOT NULL").select(F.explode(F.expr("sequence(a, b)")).alias("day"))
    return days.join(counts.filter("day IS NOT NULL"), "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


def outages(spark: SparkSession, known: list[tuple[str, str]] = OUTAGES) -> DataFrame:
    rows = [(k, *o) for k, o in enumerate(known)]
    text = spark.createDataFrame(rows, "place int, start_s string, end_s string")
    return text.select("place", F.to_timestamp("start_s").alias("start"), F.to_timestamp("end_s").alias("end"), F.concat("start_s", F.lit(" to "), "end_s").alias("period"))


def with_outage(days: DataFrame, known: DataFrame) -> DataFrame:
    """days with the period of the first outage, in the order of the list, that touches the day. Outages are exploded into days, so that the join is an equi-join."""
    per_day = known.select("place", "period", F.explode(F.expr("sequence(to_date(start), to_date(end))")).alias("day"))
    per_day = per_day.groupBy("day").agg(F.min_by("period", "place").alias("outage"))
    return days.join(per_day, "day", "left")


def explain(days: DataFrame, least: int = LEAST_ROWS) -> DataFrame:
    """(day, n, explanation, suspicious): a day with enough rows is OK, another says what is wrong and which outage is known."""
    count = F.when(F.col("n") == 0, "No data").otherwise(F.concat(F.lit("Low count ("), F.format_number("n", 0), F.lit(")")))
    why = F.concat_ws("; ", count, F.concat(F.lit("Known outage: "), F.col("outage")))
    return days.select("day", "n", F.when(F.col("n") >= least, "OK").otherwise(why).alias("explanation"), (F.col("n") < least).alias("suspicious"))


def summary(days: DataFrame) -> DataFrame:
    """One row: days, rows, mean, median, least, most and sample deviation of a day."""
    return days.agg(F.count(F.lit(1)).alias("days"), F.sum("n").alias("total"), F.round(F.avg("n"), 6).alias("mean"), F.median("n").alias("median"), F.min("n").alias("least"), F.max("n").alias("most"), F.round(F.stddev_samp("n"), 6).alias("deviation"))


def quality_report(df: DataFrame, time: str, known: DataFrame, least: int = LEAST_ROWS) -> DataFrame:
    return explain(with_outage(fill_days(daily_counts(df, time)), known), least)
