"""The registry of steps and the command line."""

from __future__ import annotations

import argparse
import sys
import time
from collections.abc import Callable
from datetime import date, datetime, timezone

from ..config import Config, load_env, session
from ..sources.store import Store
from . import study
from .drivers import Steps


def _utc(d: date) -> datetime:
    return datetime(d.year, d.month, d.day, tzinfo=timezone.utc)


#: Number, title, and what runs: in the order in which steps depend on each other, reference tables first.
STEPS: dict[str, tuple[str, Callable[[Steps, argparse.Namespace], object]]] = {
    "00a": ("reference tables", lambda s, a: s.reference(dict(x.split("=", 1) for x in a.reference)) if a.reference else None),
    "00b": ("aircraft database", lambda s, a: s.aircraft(a.aircraft) if a.aircraft else None),
    "00c": ("detection zones", lambda s, a: s.zones() if not a.no_zones else None),
    "00d": ("aerodrome layouts", lambda s, a: s.layouts(s.spark.read.parquet(a.features)) if a.features else None),
    "00e": ("airspaces", lambda s, a: s.airspaces({k: s.spark.read.parquet(p) for k, p in (x.split("=", 1) for x in a.airspace)}) if a.airspace else None),
    "01": ("ingest", lambda s, a: s.ingest(_utc(a.start), _utc(a.end))),
    "02": ("tracks", lambda s, a: s.tracks(a.start, a.end, not a.redo)),
    "02a": ("clean tracks", lambda s, a: s.clean(a.start, a.end, not a.redo)),
    "03": ("flight list", lambda s, a: (s.flights(a.start, a.end, not a.redo), s.overflights(a.start, a.end, not a.redo))),
    "04": ("events", lambda s, a: s.events(a.start, a.end, skip_done=not a.redo)),
    "05": ("export", lambda s, a: s.export(a.start, a.end, a.export_dir, a.last_n_months)),
    "06": ("clean copies", lambda s, a: s.clean_copies(a.export_dir, f"{a.export_dir}/clean")),
    "07": ("row counts", lambda s, a: s.counts()),
    "08": ("daily report", lambda s, a: s.report(f"{a.export_dir}/report_{date.today():%Y%m%d}")),
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="aerolith", description="Trajectory analytics on Spark")
    p.add_argument("command", choices=["run", "steps", "score", "sweep"])
    study.add_arguments(p)
    p.add_argument("--env", default="local")
    p.add_argument("--root", help="folder of the tables; without it they are catalog tables")
    p.add_argument("--raw", help="folder of raw hours")
    p.add_argument("--start", type=date.fromisoformat, default=date(2024, 1, 1))
    p.add_argument("--end", type=date.fromisoformat, default=date(2024, 2, 1), help="not included")
    p.add_argument("--step", action="append", help="number of a step, or the beginning of several; may be repeated")
    p.add_argument("--mode", choices=["trend", "nearest", "endpoint"])
    p.add_argument("--redo", action="store_true", help="run months that are marked as done, too")
    p.add_argument("--reference", nargs="*", default=[], metavar="NAME=CSV")
    p.add_argument("--aircraft", metavar="CSV")
    p.add_argument("--features", metavar="PARQUET")
    p.add_argument("--airspace", nargs="*", default=[], metavar="KIND=PARQUET")
    p.add_argument("--no-zones", action="store_true")
    p.add_argument("--export-dir", default="export")
    p.add_argument("--last-n-months", type=int)
    return p


def chosen(steps: list[str] | None) -> list[str]:
    return [k for k in STEPS if not steps or any(k == s or k.startswith(s) and not (s.isdigit() and k[len(s) :] and s != "00") for s in steps)]


def run(args: argparse.Namespace, config: Config | None = None) -> int:
    """0 if all steps went well, else 1."""
    from dataclasses import replace

    config = config or Config.for_environment(args.env, args.root)
    config = replace(config, **({"raw": args.raw} if args.raw else {}), **({"mode": args.mode} if args.mode else {}))
    spark = session(config)
    steps = Steps(Store(spark, config.root, config.database), config)
    steps.create_tables()
    for k in chosen(args.step):
        title, what = STEPS[k]
        began = time.time()
        try:
            result = what(steps, args)
        except Exception as e:  # a step that fails ends the run with its number
            print(f"step {k} ({title}) failed: {e}", file=sys.stderr)
            return 1
        print(f"step {k} ({title}): {'' if result is None else result} in {time.time() - began:.1f} s")
    return 0


def main(argv: list[str] | None = None) -> int:
    load_env()
    args = parser().parse_args(argv)
    if args.command == "steps":
        for k, (title, _) in STEPS.items():
            print(k, title)
        return 0
    if args.command in ("score", "sweep"):
        if not (args.tracks and args.airports and args.truth):
            parser().error(f"{args.command} needs --tracks, --airports and --truth")
        study.run(session(Config.for_environment(args.env, args.root)), args)
        return 0
    return run(args)


if __name__ == "__main__":
    sys.exit(main())
