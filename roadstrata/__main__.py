"""Run the jobs: python -m roadstrata {bronze,silver,gold} --root URI [...]

The serving database of the gold job is taken from ROADSTRATA_JDBC_URL, _DRIVER, _USER
and _PASSWORD; without a URL only Parquet is written.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys

from pyspark.sql import SparkSession

from roadstrata.plans.jobs import Layers, run_bronze, run_gold, run_silver
from roadstrata.session import build_session
from roadstrata.sinks.gold import JdbcTarget
from roadstrata.sinks.metrics import RunMetrics


def arguments(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="roadstrata", description="Telemetry layers on Spark")
    parser.add_argument("--root", required=True, help="URI under which all tables live")
    parser.add_argument("--conf", action="append", default=[], metavar="NAME=VALUE")
    jobs = parser.add_subparsers(dest="job", required=True)

    bronze = jobs.add_parser("bronze", help="land new files")
    bronze.add_argument("--source", required=True)
    bronze.add_argument("--pattern", default="*.json")
    bronze.add_argument("--ingest-date")
    bronze.add_argument("--lines", action="store_true", help="one record per line")

    silver = jobs.add_parser("silver", help="take in landed batches")
    silver.add_argument("--ingest-dates", nargs="*")
    silver.add_argument("--cluster-by", nargs="*", default=[])
    silver.add_argument("--cache", action="store_true")

    gold = jobs.add_parser("gold", help="build the star schema")
    gold.add_argument("--calendar", nargs=2, type=dt.datetime.fromisoformat, metavar=("FIRST", "LAST"))
    gold.add_argument("--dates", nargs="*", type=dt.date.fromisoformat)
    gold.add_argument("--resolve", choices=("derive", "join"), default="derive")
    gold.add_argument("--dense", nargs="*", default=[])
    gold.add_argument("--split-hot", action="store_true", help="find hot keys and cut them into pieces (join)")
    gold.add_argument("--null-safe", action="store_true")
    gold.add_argument("--grain", choices=("second", "minute", "hour"), default="second")
    gold.add_argument("--append", action="store_true", help="append the fact")
    gold.add_argument("--flat-fact", action="store_true", help="no folder per day")
    gold.add_argument("--cache", action="store_true")
    return parser.parse_args(argv)


def serving_target(environ=os.environ) -> JdbcTarget | None:
    setting = lambda name: environ.get(f"ROADSTRATA_JDBC_{name}")
    if not setting("URL"):
        return None
    return JdbcTarget(setting("URL"), setting("DRIVER"), setting("USER"), setting("PASSWORD"))


def run(spark: SparkSession, args: argparse.Namespace) -> RunMetrics:
    layers = Layers.under(args.root)
    if args.job == "bronze":
        metrics = run_bronze(
            spark, args.source, layers, args.ingest_date, not args.lines, args.pattern
        )
    elif args.job == "silver":
        metrics = run_silver(
            spark, layers, args.ingest_dates, cluster_by=args.cluster_by, cache_flat=args.cache
        )
    else:
        metrics = run_gold(
            spark,
            layers,
            calendar=args.calendar and tuple(args.calendar),
            dates=args.dates,
            resolve=args.resolve,
            dense=args.dense,
            null_safe=args.null_safe,
            split_hot=args.split_hot,
            grain=args.grain,
            fact_mode="append" if args.append else "overwrite",
            partition_fact=not args.flat_fact,
            jdbc=serving_target(),
            cache_silver=args.cache,
        )
    metrics.write(spark, layers.metrics)
    return metrics


def main(argv: list[str] | None = None) -> None:
    args = arguments(sys.argv[1:] if argv is None else argv)
    spark = build_session(
        f"roadstrata-{args.job}", conf=dict(pair.split("=", 1) for pair in args.conf)
    )
    try:
        for _, stage, rows, taken in run(spark, args).entries:
            print(f"{stage:32s}{'' if rows is None else rows:>14}{taken:10.1f}s")
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
