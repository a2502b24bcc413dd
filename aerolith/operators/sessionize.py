"""Gap sessions: rows of a key, in order of time, are cut where the gap to the row before is too long."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import TrackParams


@dataclass(frozen=True)
class Gap:
    """A cut: the gap is longer than so many seconds (or as long, if inclusive) and the condition holds of the row after it."""

    seconds: float
    when: Column | None = None
    inclusive: bool = False


def seconds(time: str | Column) -> Column:
    """Whole seconds since the epoch."""
    t = F.col(time) if isinstance(time, str) else time
    return F.unix_timestamp(t.cast("timestamp"))


def sessions(df: DataFrame, keys: list[str], time: str, gaps: list[Gap], out: str, base: int = 0) -> DataFrame:
    """df with the number of each row's session among those of its key. A first row cuts nothing; a NULL condition does not hold."""
    w = Window.partitionBy(*keys).orderBy(time)
    gap = seconds(time) - seconds(F.lag(time).over(w))
    cut = F.lit(False)
    for g in gaps:
        long = gap >= g.seconds if g.inclusive else gap > g.seconds
        cut |= F.coalesce(long & g.when if g.when is not None else long, F.lit(False))
    flagged = df.withColumn("_cut", cut.cast("int"))
    running = F.sum("_cut").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return flagged.withColumn(out, running + base).drop("_cut")


def group_id(icao24: str = "icao24", callsign: str = "callsign") -> Column:
    """Sixteen hex digits of an airframe and its callsign; a NULL callsign leaves the airframe alone."""
    return F.substring(F.sha2(F.concat_ws("", icao24, callsign), 256), 1, 16)


def track_ids(df: DataFrame, p: TrackParams = TrackParams()) -> DataFrame:
    """df with track_id: group, session, and year and month of the row. A session ends after a long gap, or after a shorter one if the row after it is low.

    Rows with neither airframe nor callsign are nobody's: they are parted by the hour, which stands before their session, so that they are not one key of any size.
    """
    low = F.col("baro_altitude") < p.low_altitude_m
    hour = F.when(F.col("icao24").isNull() & F.col("callsign").isNull(), F.floor(seconds("event_time") / 3600))
    rows = sessions(df.withColumns({"_group": group_id(), "_hour": hour}), ["_group", "_hour"], "event_time", [Gap(p.gap_minutes * 60), Gap(p.low_gap_minutes * 60, low)], "_session")
    session = F.concat_ws("-", F.col("_hour").cast("string"), F.col("_session").cast("string"))
    return rows.withColumn("track_id", F.concat_ws("_", "_group", session, F.year("event_time").cast("string"), F.month("event_time").cast("string"))).drop("_group", "_session", "_hour")


def segment_ids(df: DataFrame, gap_seconds: float = 300) -> DataFrame:
    """df with segment_id: the track and the number of the segment, from 1. A gap as long as the limit cuts."""
    rows = sessions(df, ["track_id"], "event_time", [Gap(gap_seconds, inclusive=True)], "_segment", base=1)
    return rows.withColumn("segment_id", F.concat_ws("_", "track_id", F.col("_segment").cast("string"))).drop("_segment")
