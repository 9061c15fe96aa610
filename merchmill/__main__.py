"""Command line: ``spark-submit ... -m merchmill`` or ``python -m merchmill``."""

from __future__ import annotations

import argparse
import json
from datetime import date, datetime

from pyspark.sql import SparkSession

from merchmill import values
from merchmill.config import ShopConfig
from merchmill.plans import jobs
from merchmill.sources.storage import clear_scratch


STEPS = ("ingest", "stage", "export", "load", "fact", "marts", "test")


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="merchmill", description="Run the shop's daily job.")
    parser.add_argument("--seed", action="store_true", help="ingest all history (once, at the start)")
    parser.add_argument("--backfill", action="store_true", help="seed, then build every table from all history")
    parser.add_argument("--date", type=date.fromisoformat, default=None, help="day to run, YYYY-MM-DD (today)")
    parser.add_argument("--limit", type=int, default=values.DEFAULT_DAILY_ORDERS,
                        help="order lines per day; 0 takes the whole day and adds none")
    parser.add_argument("--ingest-only", action="store_true", help="stop after ingesting the day")
    parser.add_argument("--full-refresh", action="store_true", help="rebuild the fact from all loaded orders")
    parser.add_argument("--step", choices=STEPS, help="run one step of the day alone")
    parser.add_argument("--load-mode", choices=("replace", "append"))
    parser.add_argument("--lookback-days", type=int)
    parser.add_argument("--increment", choices=("lookback", "ledger"), help="what a later build of the fact reads")
    parser.add_argument("--quarantine", action="store_true", default=None, help="set aside what can't be read of the files")
    parser.add_argument("--threads", type=int)
    parser.add_argument("--multiline-files", nargs="*", help="source tables whose cells may hold line breaks")
    parser.add_argument("--root")
    parser.add_argument("--source-dir")
    parser.add_argument("--target", choices=("dev", "prod"))
    parser.add_argument("--grain", choices=("order", "line"))
    parser.add_argument("--partition-by", choices=("day", "month"))
    return parser.parse_args(argv)


def config_from(args: argparse.Namespace) -> ShopConfig:
    names = ("root", "source_dir", "target", "grain", "partition_by", "load_mode", "lookback_days", "increment", "quarantine",
             "threads", "multiline_files")
    given = {n: getattr(args, n) for n in names if getattr(args, n) is not None}
    if "multiline_files" in given:
        given["multiline_files"] = tuple(given["multiline_files"])
    return ShopConfig.from_env(daily_orders=args.limit if args.limit > 0 else None, **given)


def run_step(
    spark: SparkSession, config: ShopConfig, step: str, run_date: date, now: datetime, full_refresh: bool
) -> object:
    """One step of ``run_day``, for a scheduler that retries steps one by one."""
    return {
        "ingest": lambda: jobs.ingest_day(spark, config, run_date, now),
        "stage": lambda: jobs.stage_day(spark, config, run_date, stamped=now.date()),
        "export": lambda: jobs.export_day(spark, config, run_date),
        "load": lambda: jobs.load_day(spark, config, run_date),
        "fact": lambda: jobs.build_fact(spark, config, run_date, full_refresh),
        "marts": lambda: jobs.build_marts(spark, config, []),  # those of the fact folders noted as changed
        "test": lambda: jobs.test_models(spark, config),
    }[step]()


def run(
    spark: SparkSession, config: ShopConfig, args: argparse.Namespace, run_date: date, now: datetime
) -> dict[str, object]:
    if args.seed:
        return {"ingested": jobs.seed_history(spark, config, now)}
    if args.backfill:
        return jobs.run_history(spark, config, run_date, now)
    if args.step:
        return {args.step: run_step(spark, config, args.step, run_date, now, args.full_refresh)}
    if args.ingest_only:
        return {"ingested": jobs.ingest_day(spark, config, run_date, now)}
    return jobs.run_day(spark, config, run_date, now, full_refresh=args.full_refresh)


def main(argv: list[str] | None = None) -> dict[str, object]:
    args = parse(argv)
    config = config_from(args)
    run_date = args.date or date.today()
    spark = SparkSession.builder.appName("merchmill").getOrCreate()
    now = datetime.now() if args.date is None else datetime.combine(args.date, datetime.min.time())
    try:
        done = run(spark, config, args, run_date, now)
    finally:
        clear_scratch(spark)
    print(json.dumps(done, default=str))
    return done


if __name__ == "__main__":
    main()
