"""Command-line load: read the three sheets, build, validate, publish.

    python -m ledgerloom --orders s3://…/orders/ --people s3://…/people/ \\
        --returns s3://…/returns/ --base s3://…/warehouse \\
        [--format csv] [--locale-numbers] [--date-format M/d/yyyy] [--strict]

(with spark-submit: ``tools/run_load.py`` takes the same arguments)

Prints the validation report; the exit code is 0 when the run was published
and 1 otherwise, so a scheduler can gate on it.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .plans.publish import run_and_publish
from .plans.validate import expected_counts, expected_totals
from .schemas import TABLE_ORDER
from .sources.readers import read_sheet


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="ledgerloom", description=__doc__.splitlines()[0])
    p.add_argument("--orders", required=True, help="orders sheet (files or folder)")
    p.add_argument("--people", required=True, help="people sheet")
    p.add_argument("--returns", required=True, help="returns sheet")
    p.add_argument("--base", required=True, help="warehouse folder (runs and manifest)")
    p.add_argument("--format", default="csv", help="csv (default) or parquet")
    p.add_argument("--locale-numbers", action="store_true",
                   help="numbers written as '1 234,56'")
    p.add_argument("--date-format", action="append", default=None,
                   help="extra date pattern, e.g. M/d/yyyy (repeatable)")
    p.add_argument("--option", action="append", default=[], metavar="NAME=VALUE",
                   help="reader option, e.g. delimiter=; or encoding=ISO-8859-1 (repeatable)")
    p.add_argument("--expect-rows", action="append", default=[], metavar="TABLE=N",
                   help="known row count of a target table (repeatable; all nine or none)")
    p.add_argument("--expect-sales", type=float, help="known total of sales (with --expect-profit)")
    p.add_argument("--expect-profit", type=float, help="known total of profit (with --expect-sales)")
    p.add_argument("--no-stage", action="store_true", help="don't copy raw rows that are Parquet already")
    p.add_argument("--lenient", action="store_true", help="unreadable cells become NULL")
    p.add_argument("--strict", action="store_true", help="stop on natural or lookup key violations")
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parse_args(argv)
    spark = spark or SparkSession.builder.appName("ledgerloom").getOrCreate()
    dates = tuple(args.date_format) if args.date_format else None

    def sheet(path: str, name: str):
        return read_sheet(spark, path, name, fmt=args.format, locale_numbers=args.locale_numbers,
                          strict=not args.lenient, date_formats=dates,
                          options=dict(o.split("=", 1) for o in args.option))

    rows = {k: int(v) for k, v in (x.split("=", 1) for x in args.expect_rows)}
    if rows and set(rows) != set(TABLE_ORDER):
        raise SystemExit(f"--expect-rows needs all of {', '.join(TABLE_ORDER)}")
    if (args.expect_sales is None) != (args.expect_profit is None):
        raise SystemExit("--expect-sales and --expect-profit go together")
    sums = None if args.expect_sales is None else expected_totals(spark, args.expect_sales, args.expect_profit)

    run = run_and_publish(sheet(args.orders, "orders"), sheet(args.people, "people"),
                          sheet(args.returns, "returns"), args.base, strict=args.strict,
                          expected_rows=expected_counts(spark, rows) if rows else None,
                          expected_sums=sums, stage_raw=not args.no_stage)
    run.report.orderBy("check_group", "check_name").show(200, truncate=False)
    print(f"run {run.run_dir}: {'published' if run.published else 'NOT published'}")
    return 0 if run.published else 1


if __name__ == "__main__":
    sys.exit(main())
