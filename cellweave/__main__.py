"""``python -m cellweave fetch | extract | transform | load | assemble | build | sync``."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from cellweave.plans import runner
from cellweave.plans.sync import POLICIES, sync
from cellweave.sources.features import read_features
from cellweave.sources.fetch import CATALOGUE, data_dir, data_source, obtain
from cellweave.steps.base import RESOLUTIONS
from cellweave.steps.datasets import DATASETS
from cellweave.steps.transforms import STEPS


def features_of(raw: Path, name: str) -> Path:
    return raw / name / "features.parquet"


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="cellweave", description=__doc__)
    parser.add_argument("command", choices=["fetch", "extract", "transform", "load", "assemble", "build", "sync"])
    parser.add_argument("--only", action="append", default=[], choices=[d.name for d in DATASETS], help="extract: this dataset (repeatable)")
    parser.add_argument("--catalogue", type=Path, help="fetch: JSON file that says how each source is had, instead of the one that comes along; sources.json in the data folder goes before either")
    parser.add_argument("--force-download", action="store_true", help="fetch: also what is there already")
    parser.add_argument("--all", action="store_true", help="rebuild what exists")
    parser.add_argument("--include", action="append", default=[], help="load: a further relation (repeatable)")
    parser.add_argument("--resolution", action="append", type=int, default=[], help="cell resolution (repeatable)")
    parser.add_argument("--remote", help="sync: the other folder, in any store that Spark reaches")
    parser.add_argument("--policy", choices=POLICIES, default="ignore")
    args = parser.parse_args(argv)
    root, resolutions = data_dir(), tuple(args.resolution) or RESOLUTIONS
    spark = SparkSession.builder.appName("cellweave").config("spark.sql.session.timeZone", "UTC").config("spark.scheduler.mode", "FAIR").getOrCreate()
    raw, failed = root / "raw", 0
    if args.command == "fetch":
        for name in [s for d in DATASETS if not args.only or d.name in args.only for s in d.sources or (d.name,)]:
            try:
                entry = data_source(name, args.catalogue or CATALOGUE, root / "sources.json")
                if "features" not in entry:
                    found = obtain(entry, raw / name, args.force_download)
                elif args.force_download or not runner.complete(spark, found := features_of(raw, name)):
                    found = runner.write_table(read_features(spark, entry["features"]), features_of(raw, name))
                print(name, found)
            except (OSError, ValueError, PySparkException) as error:
                print(f"{name} not fetched: {error}", file=sys.stderr)
                failed = 1
        return failed
    if args.command in ("extract", "build"):
        for name, outcome in runner.run_extracts(spark, DATASETS, root / "extract", lambda n: f"{features_of(raw, n) if runner.complete(spark, features_of(raw, n)) else raw / n}", args.only, args.all).items():
            print(name, f"{outcome.value}" if outcome.ok else f"failed: {outcome.error}")
            failed |= not outcome.ok
    if args.command in ("transform", "assemble", "build"):
        runner.run_steps(spark, STEPS, root / "extract", root / "transform", resolutions=resolutions, rebuild=args.all)
    if args.command in ("load", "assemble", "build"):
        print(*runner.publish(spark, root / "bundle", [root / "transform", root / "extract"], resolutions, args.include))
    if args.command == "sync":
        if args.remote is None:
            parser.error("sync needs --remote")
        for name, action in sync(spark, root / "extract", args.remote, args.policy).items():
            print(action, name)
    return failed


if __name__ == "__main__":
    raise SystemExit(main())
