"""Jobs for spark-submit: ``python -m hanok.jobs <job> ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hanok.operators import ledger, worklist
from hanok.operators.changes import page_totals
from hanok.operators.quality import code_list
from hanok.plans import landing, refresh
from hanok.schema import RESPONSE_SCHEMA
from hanok.session import build_session
from hanok.sinks import files, lake
from hanok.sources.bronze import read_pages
from hanok.streaming.reflect import reflect_new_pages


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="hanok.jobs")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, text: str, *options: str) -> argparse.ArgumentParser:
        p = jobs.add_parser(name, help=text)
        for option in options:
            p.add_argument(f"--{option}", required=True)
        p.add_argument("--format", default=lake.PARQUET, choices=[lake.PARQUET, lake.ICEBERG])
        return p

    for name, text, options in (
        ("full-load", "load the whole landing zone", ("bronze",)),
        ("incremental-load", "reflect one run's manifest", ("manifest",)),
        ("stream-load", "take up new page files and stop", ("bronze",)),
        ("drop-table", "drop the raw table", ()),
    ):
        p = job(name, text, *options)
        p.add_argument("--table", default=refresh.RAW_TABLE)
        p.add_argument("--location")
        if name == "incremental-load":
            source = p.add_mutually_exclusive_group(required=True)
            source.add_argument("--bronze", help="the landing zone")
            source.add_argument("--pages", help="the page table")
        if name == "full-load":
            p.add_argument("--recreate", action="store_true")
            p.add_argument("--append", action="store_true")
            p.add_argument("--header", help="the header line all pages have, if they do")
    p = job("build-marts", "build typed trades and marts from the raw table", "database")
    p.add_argument("--table", default=refresh.RAW_TABLE)
    job("write-boards", "write the boards over the marts", "database")
    job("write-price-changes", "write the price change datasets of a period", "database", "start", "end")
    for name, text, options in (
        ("land-answers", "land fetched answers as pages", ("answers",)),
        ("daily-sync", "land answers, reflect them into the raw table, update the marts", ("answers", "database")),
        ("worklist", "plan the next run's requests", ("codes", "quota", "out")),
        ("change-report", "one line per run: requests, pages, actions, cursor", ("codes",)),
        ("audit", "findings per partition and pages never seen", ("out",)),
    ):
        p = job(name, text, *options)
        p.add_argument("--pages", *(["--table"] if name == "land-answers" else []), default=landing.PAGE_TABLE, help="the page table")
        p.add_argument("--markers", default=landing.MARKER_TABLE)
        p.add_argument("--day", help="the last day of the keyspace, today by default")
        p.add_argument("--months", type=int, default=120)
        if name in ("land-answers", "daily-sync"):
            p.add_argument("--run", help="the run's id; the same id finishes a run that died")
            p.add_argument("--quota-limit", type=int)
            p.add_argument("--codes", help="the region codes, for the manifest")
            p.add_argument("--manifest", help="where the run's manifest goes")
        if name == "land-answers":
            p.add_argument("--write-once", action="store_true", help="leave pages that hold rows as they are")
        if name == "daily-sync":
            p.add_argument("--table", default=refresh.RAW_TABLE)
    return parser


def _keyspace(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame, Column]:
    """The region codes, and the last day of the months to plan for."""
    return code_list(read_pages(spark, args.codes, columns=None)), F.lit(args.day).cast("date") if args.day else F.current_date()


def _slots(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return worklist.keyspace(*_keyspace(spark, args), args.months)


def _land(spark: SparkSession, args: argparse.Namespace) -> None:
    answers = spark.read.schema(RESPONSE_SCHEMA).parquet(args.answers)
    known = {"run_id": args.run} if args.run else {}
    run = landing.Run(**known, quota_limit=args.quota_limit)
    if args.job == "land-answers":
        landing.land_answers(spark, answers, args.pages, args.markers, table_format=args.format, run=run, write_once=args.write_once)
    else:
        lake.create_database(spark, args.database)
        refresh.daily_sync(spark, answers, args.database, args.pages, args.markers, args.table, run, args.format)
    log = spark.table(landing.run_table(args.pages))
    log.where(F.col("run_id") == run.run_id).groupBy("action").count().show()
    if args.manifest:
        files.write_manifest(ledger.manifest(log, _slots(spark, args), run.run_id), args.manifest)


def _plan(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """The next run's worklist: from the log's cursor on, without partitions that have a marker."""
    cursor = ledger.resume_point(spark.table(landing.run_table(args.pages)), _slots(spark, args))
    totals = page_totals(spark.table(landing.index_table(args.pages)))
    return worklist.crawl_plan(*_keyspace(spark, args), totals, int(args.quota), args.months, cursor=cursor, done=spark.table(args.markers))


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session(f"hanok-{args.job}")
    if args.job == "full-load":
        header = args.header.split(",") if args.header else None
        refresh.full_load(spark, args.bronze, args.table, args.location, args.recreate, args.append, args.format, header)
    elif args.job == "incremental-load":
        done = refresh.incremental_load(spark, args.bronze, args.manifest, args.table, args.location, args.format, args.pages)
        print("reflected" if done else "nothing to do")
    elif args.job == "stream-load":
        reflect_new_pages(spark, args.bronze, args.table, location=args.location, table_format=args.format).awaitTermination()
    elif args.job == "drop-table":
        lake.drop_table(spark, args.table)
    elif args.job == "build-marts":
        lake.create_database(spark, args.database)
        refresh.build_marts(spark, spark.table(args.table), args.database, args.format)
    elif args.job == "write-boards":
        print("\n".join(refresh.write_boards(spark, args.database, args.format)))
    elif args.job == "write-price-changes":
        print("\n".join(refresh.write_price_changes(spark, args.database, args.start, args.end, args.format)))
    elif args.job in ("land-answers", "daily-sync"):
        _land(spark, args)
    elif args.job == "worklist":
        files.write_parquet(_plan(spark, args).select("lawd_cd", "deal_ym", "start_page", "total_pages", "fetched", "percent"), args.out)
    elif args.job == "change-report":
        ledger.run_summaries(spark.table(landing.run_table(args.pages)), _slots(spark, args)).orderBy("started_at").show(1000, truncate=False)
    elif args.job == "audit":
        files.write_parquet(landing.audit(spark, args.pages, args.markers), args.out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
