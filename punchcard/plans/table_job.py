"""Command line of the table job, for spark-submit."""

from __future__ import annotations

import argparse
import re

from pyspark.sql import SparkSession

from punchcard.plans.jobs import login_summary_table
from punchcard.sinks import check_catalog

_INPUT = r".+\.csv|.+/|.*[*?\[{].*"
_NAME = r"(?:\w+|`[^`]+`)"
_TABLE = rf"(?:{_NAME}\.){{0,2}}{_NAME}"


def _input_path(text: str) -> str:
    if not re.fullmatch(_INPUT, text):
        raise argparse.ArgumentTypeError(
            f"{text!r} is not a .csv file, a directory (ending in /) or a glob"
        )
    return text


def _table_name(text: str) -> str:
    if not re.fullmatch(_TABLE, text):
        raise argparse.ArgumentTypeError(f"{text!r} is not [catalog.][schema.]table")
    return text


def parse_arguments(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Append a login summary to a table.")
    parser.add_argument("--input_csv_file", required=True, type=_input_path)
    output = parser.add_mutually_exclusive_group(required=True)
    output.add_argument("--output_table", type=_table_name, help="needs a catalog that lasts")
    output.add_argument("--output_path", help="a directory of Parquet files")
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> dict[str, int]:
    options = parse_arguments(arguments)
    spark = SparkSession.builder.appName("login-summary").getOrCreate()
    if options.output_table:
        check_catalog(spark, options.output_table)
    counts = login_summary_table(
        spark, options.input_csv_file, options.output_table, options.output_path
    )
    print(counts)
    return counts


if __name__ == "__main__":
    main()
