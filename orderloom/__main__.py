"""Command line: build a mart from CSV files; exits 1 if it is not published."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from orderloom.plans.checks import CHECKS
from orderloom.plans.job import PublishBlocked, run_pipeline
from orderloom.schemas import DEFAULT_RULES, Rules
from orderloom.sources.csv_files import read_csv_sources


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="orderloom")
    parser.add_argument("--customers", required=True)
    parser.add_argument("--products", required=True)
    parser.add_argument("--orders", required=True)
    parser.add_argument("--root", required=True, help="folder that holds the mart")
    parser.add_argument("--multiline", action="store_true", help="quoted line breaks occur")
    parser.add_argument("--fact-by-year", action="store_true")
    parser.add_argument("--fail-on", nargs="*", default=[], choices=[*CHECKS, "all"])
    parser.add_argument("--allow-empty", action="store_true", help="publish empty tables too")
    parser.add_argument("--date-formats", nargs="+", default=DEFAULT_RULES.date_formats)
    parser.add_argument("--payments", nargs="+", default=DEFAULT_RULES.payments)
    parser.add_argument("--statuses", nargs="+", default=DEFAULT_RULES.statuses)
    args = parser.parse_args(argv)
    rules = Rules(tuple(args.payments), tuple(args.statuses), tuple(args.date_formats))
    spark = SparkSession.builder.appName("orderloom").getOrCreate()
    staged = read_csv_sources(
        spark, args.customers, args.products, args.orders, rules, args.multiline
    )
    fail_on = list(CHECKS) if "all" in args.fail_on else args.fail_on
    try:
        result = run_pipeline(
            spark,
            staged,
            args.root,
            rules,
            fail_on=fail_on,
            fact_by_year=args.fact_by_year,
            allow_empty=args.allow_empty,
        )
    except PublishBlocked as blocked:
        print(blocked, file=sys.stderr)
        return 1
    for name, rows in {**result.source_rows, **result.table_rows}.items():
        print(f"{name}\t{rows}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
