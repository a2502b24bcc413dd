"""Parameters of the operators, one frozen object per operator family."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TrackParams:
    gap_minutes: float = 30
    low_gap_minutes: float = 15
    low_altitude_m: float = 1524
    smooth_seconds: int = 300
    max_climb_ms: float = 25.4
    resolutions: tuple[int, ...] = (7, 12)


#: First- and second-difference limits in aviation units per second, and the factor from stored units.
SPIKE_LIMITS = {
    "lat": (0.01, 0.06, 1.0),
    "lon": (0.01, 0.06, 1.0),
    "baro_altitude": (200.0, 50.0, 3.28084),
    "geo_altitude": (200.0, 150.0, 3.28084),
    "velocity": (12.0, 10.0, 1.94384),
    "heading": (12.0, 10.0, 1.0),
    "vert_rate": (1500.0, 1000.0, 196.850394),
}


@dataclass(frozen=True)
class CleanParams:
    enabled: bool = True
    dedup: bool = True
    ranges: bool = True
    stale: bool = True
    spikes: bool = True
    isolated: bool = True
    segments: bool = True
    pandas_stages: bool = False
    isolated_seconds: float = 20
    segment_gap_seconds: float = 300
    limits: dict[str, tuple[float, float, float]] = field(default_factory=lambda: dict(SPIKE_LIMITS))


@dataclass(frozen=True)
class Box:
    """Area of interest, degrees, borders included."""

    west: float = -25.86653
    south: float = 26.74617
    east: float = 49.65699
    north: float = 70.25976


@dataclass(frozen=True)
class EndpointParams:
    radius_nm: float = 40
    height_ft: float = 15000
    scheduled_penalty_nm: float = 10
    out_of_area: bool = True
    border_nm: float = 30


@dataclass(frozen=True)
class TrendParams:
    max_fl: int = 40
    radius_nm: float = 30
    margin: int = 4


@dataclass(frozen=True)
class EventParams:
    levels: tuple[int, ...] = (50, 70, 100, 245)
    level_tolerance: float = 10
    surface_fl: float = 20
    trace_gap_seconds: float = 300
    first_takeoff_only: bool = False
    source: str = "OSN"
    version: str = "events_v0.0.2"
    distance_version: str = "distance_v0.0.2"
    time_version: str = "time_v0.0.1"
