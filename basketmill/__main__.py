"""Command line: load files, profile the layers, build the result tables, show a job or what was built.

    python -m basketmill load lines.csv --location /shared/shop
    python -m basketmill quality --location /shared/shop
    python -m basketmill results --location /shared/shop
    python -m basketmill show top_countries --location /shared/shop
    python -m basketmill stored cohort_retention_matrix --location /shared/shop
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from basketmill.operators.staging import staging_job
from basketmill.plans.quality import quality_reports
from basketmill.plans.registry import JOBS, RESULT_TABLES, STORED_RESULTS
from basketmill.session import get_spark, size_session
from basketmill.sources.files import odd_lines
from basketmill.warehouse import Warehouse


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    shared = argparse.ArgumentParser(add_help=False)
    shared.add_argument("--location", required=True, help="folder of the stored tables, which later commands attach")
    shared.add_argument("--database", default="default")
    shared.add_argument("--master", help="Spark master, if spark-submit does not set it")
    parser = argparse.ArgumentParser(prog="basketmill", description="Retail analytics on Spark")
    commands = parser.add_subparsers(dest="command", required=True)
    load = commands.add_parser("load", parents=[shared], help="files -> raw and cleaned lines")
    load.add_argument("path")
    load.add_argument("--encoding", default="ISO-8859-1")
    load.add_argument("--strict", action="store_true", help="also fail on lines with too few fields")
    load.add_argument("--on-extra-fields", choices=["raise", "reject"], default="raise")
    load.add_argument("--on-fine-price", choices=["raise", "round"], default="raise")
    load.add_argument("--on-bad-number", choices=["raise", "reject"], default="raise")
    load.add_argument("--on-bad-date", choices=["raise", "null"], default="raise")
    load.add_argument("--dedup", action="store_true")
    load.add_argument("--by-month", action="store_true")
    commands.add_parser("quality", parents=[shared], help="profile of the raw and cleaned lines")
    commands.add_parser("results", parents=[shared], help="build all result tables")
    show = commands.add_parser("show", parents=[shared], help="run one job and show its rows")
    show.add_argument("job", choices=JOBS)
    show.add_argument("--rows", type=int, default=100)
    stored = commands.add_parser("stored", parents=[shared], help="show what was built, without reading any line")
    stored.add_argument("result", choices=[*RESULT_TABLES, *STORED_RESULTS])
    stored.add_argument("--rows", type=int, default=100)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = get_spark(master=args.master)
    size_session(spark, args.path if args.command == "load" else args.location)
    try:
        with staging_job(spark):
            _run(args, spark, Warehouse(spark, args.database, args.location))
    except LookupError as error:  # a table that was never built
        raise SystemExit(f"{error}") from error


def _run(args: argparse.Namespace, spark: SparkSession, warehouse: Warehouse) -> None:
    if args.command == "load":
        for problem in odd_lines(spark, args.path, args.encoding).groupBy("problem").count().collect():
            print("lines with", problem["problem"], problem["count"])
        names = ("on_extra_fields", "on_fine_price", "on_bad_number")
        options = {name: getattr(args, name) for name in names}
        print("raw lines", warehouse.build_ods(args.path, encoding=args.encoding, strict=args.strict, **options))
        print("cleaned lines", warehouse.build_dwd(args.on_bad_date, args.dedup, args.by_month))
    elif args.command == "results":
        for table, rows in warehouse.build_ads().items():
            print(table, rows)
    elif args.command == "stored":
        warehouse.result(args.result).show(args.rows, truncate=False)
    else:
        source = warehouse.source()
        reports = quality_reports(source) if args.command == "quality" else {args.job: JOBS[args.job](source)}
        for name, report in reports.items():
            print(name)
            report.show(getattr(args, "rows", 100), truncate=False)


if __name__ == "__main__":
    main()
