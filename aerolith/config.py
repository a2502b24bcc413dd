"""Configuration by environment."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import SparkSession

from .params import Box, CleanParams, EndpointParams, EventParams, TrackParams, TrendParams


@dataclass(frozen=True)
class Cluster:
    """Sizes of a session. Shuffle partitions are a starting point that adaptive execution coalesces."""

    master: str | None = None
    executors_most: int = 20
    executor_cores: int = 4
    executor_memory: str = "16g"
    driver_memory: str = "8g"
    shuffle_partitions: int = 2000
    extra: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        out = {
            "spark.executor.cores": str(self.executor_cores),
            "spark.executor.memory": self.executor_memory,
            "spark.driver.memory": self.driver_memory,
            "spark.dynamicAllocation.enabled": "true",
            "spark.dynamicAllocation.shuffleTracking.enabled": "true",
            "spark.dynamicAllocation.maxExecutors": str(self.executors_most),
            "spark.sql.shuffle.partitions": str(self.shuffle_partitions),
            "spark.sql.adaptive.enabled": "true",
            "spark.sql.adaptive.skewJoin.enabled": "true",
            "spark.sql.session.timeZone": "UTC",
            "spark.sql.parquet.filterPushdown": "true",
            "spark.shuffle.compress": "true",
            "spark.shuffle.spill.compress": "true",
        }
        if self.master:
            out |= {"spark.master": self.master}
            if self.master.startswith("local"):
                out |= {"spark.dynamicAllocation.enabled": "false", "spark.ui.enabled": "false"}
        return out | self.extra


@dataclass(frozen=True)
class Config:
    name: str
    cluster: Cluster
    root: str | None = None
    database: str | None = None
    raw: str | None = None
    every_s: int = 5
    box: Box = Box()
    tracks: TrackParams = TrackParams()
    clean: CleanParams = CleanParams()
    endpoint: EndpointParams = EndpointParams()
    trend: TrendParams = TrendParams()
    events: EventParams = EventParams()
    mode: str = "trend"
    use_clean_tracks: bool = False

    @classmethod
    def for_environment(cls, name: str, root: str | None = None) -> Config:
        made = {
            "local": lambda: cls("local", Cluster("local[*]", 1, 4, "4g", "4g", 16), root or "warehouse"),
            "dev": lambda: cls("dev", Cluster(executors_most=20), root, None if root else "dev"),
            "live": lambda: cls("live", Cluster(executors_most=20), root, None if root else "live"),
            "research": lambda: cls("research", Cluster(executors_most=12, executor_cores=2, executor_memory="12g", shuffle_partitions=400), root or "research", every_s=5, mode="endpoint"),
        }
        if name not in made:
            raise ValueError(f"unknown environment {name!r}; one of {sorted(made)}")
        return made[name]()


def load_env(*files: str) -> dict[str, str]:
    """Settings of the first of the files that there is; those already in the environment stay."""
    for f in files or (".env",):
        path = Path(f)
        if path.is_file():
            pairs = dict(line.split("=", 1) for line in map(str.strip, path.read_text().splitlines()) if line and not line.startswith("#") and "=" in line)
            pairs = {k.strip(): v.strip().strip("'\"") for k, v in pairs.items()}
            for k, v in pairs.items():
                os.environ.setdefault(k, v)
            return pairs
    return {}


def session(config: Config, app: str = "aerolith") -> SparkSession:
    """The running session, or one with the configuration's sizes."""
    return SparkSession.builder.appName(f"{app}-{config.name}").config(map=config.cluster.options()).getOrCreate()
