"""One query per operator, over lines derived from the whole of ``lineitem``.

Each takes the session and the folder of the tables and returns a DataFrame.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punchcard.functions import format_timestamp, is_header, parse_timestamp
from punchcard.operators import (
    CLOSED,
    OPEN,
    carried_attributes,
    first_logins,
    keep,
    last_logouts,
    login_records,
    login_summary,
    parse_lines,
    reject_counts,
    split_lines,
    text_records,
    to_lines,
    union_lines,
)
from punchcard.operators.records import RECORD_COLUMNS
from punchcard.operators.summary import SUMMARY_COLUMNS
from punchcard.plans import table_job
from punchcard.plans.derived import login_lines
from punchcard.plans.jobs import login_summary_csv, login_summary_table
from punchcard.plans.shared import fresh_folder, shared_folder
from punchcard.sinks import CSV_HEADER, append_summary
from punchcard.sources import literal_lines, read_lines, read_lines_after_first


# Written input by application, form and the files it was derived from.
_WRITTEN: dict[tuple, str] = {}


def _files(spark: SparkSession, path: str) -> tuple:
    """Number and digest of the names, lengths and times of a table's files, unread."""
    found = spark.read.format("binaryFile").load(path)
    digest = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    return tuple(found.agg(F.count(F.lit(1)), F.sum(digest)).first())


def _written(spark: SparkSession, sf_dir: str, form: str, write: Callable[[str], None]) -> str:
    source = f"{sf_dir}/lineitem.parquet"
    key = (spark.sparkContext.applicationId, form, source, *_files(spark, source))
    if key not in _WRITTEN:
        folder = fresh_folder(spark, form)
        write(folder)
        _WRITTEN[key] = folder
    return _WRITTEN[key]


def _written_lines(spark: SparkSession, sf_dir: str) -> str:
    lines = login_lines(spark, sf_dir)
    return _written(spark, sf_dir, "lines", lines.write.text)


def _quoted(text: str) -> Column:
    return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))


def _written_records(spark: SparkSession, sf_dir: str) -> str:
    """The records of mode open as CSV, twice.

    Once the first line of each part is a header; once each line, with another id, has
    blank lines before it, and so each part begins with those. The lines are derived and
    parsed once, for both.
    """
    parsed = login_records(login_lines(spark, sf_dir), OPEN).select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in RECORD_COLUMNS]
    )
    line = F.concat_ws(
        ",",
        F.concat(F.lit("B"), "employee_id"),
        _quoted("name"),
        _quoted("department"),
        "login",
        "logout",
    )

    def write(folder: str) -> None:
        once = fresh_folder(spark, "parsed")
        parsed.write.parquet(once)
        records = spark.read.schema(parsed.schema).parquet(once)
        # A header that does not start with the prefix: only its place drops it.
        (
            records.toDF("id", *RECORD_COLUMNS[1:])
            .write.option("header", True)
            .option("escape", '"')
            .option("emptyValue", "")
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(folder + "/headed")
        )
        records.select(F.concat(F.lit("\n  \n"), line)).write.text(folder + "/blank_first")

    return _written(spark, sf_dir, "records", write) + "/*"


def _as_text(records: DataFrame) -> DataFrame:
    return records.withColumns({c: F.col(c).cast("string") for c in ("login", "logout")})


def scan_lines(spark, sf_dir):
    return text_records(read_lines(spark, _written_lines(spark, sf_dir)), OPEN)


def scan_skip_first(spark, sf_dir):
    folder = _written_records(spark, sf_dir)
    return text_records(read_lines_after_first(spark, folder), CLOSED)


def split_fields(spark, sf_dir):
    return split_lines(login_lines(spark, sf_dir)).drop("is_header")


def drop_header_prefix(spark, sf_dir):
    return login_lines(spark, sf_dir).filter(~is_header(F.col("value")))


def arity_open(spark, sf_dir):
    return text_records(login_lines(spark, sf_dir), OPEN)


def arity_closed(spark, sf_dir):
    return text_records(login_lines(spark, sf_dir), CLOSED)


def parse_ts(spark, sf_dir):
    text = F.col("login_text")
    return split_lines(login_lines(spark, sf_dir)).select(
        "employee_id",
        "login_text",
        parse_timestamp(text).cast("string").alias("as_it_stands"),
        format_timestamp(parse_timestamp(text, strip_first=True)).alias("stripped"),
    )


def parse_optional_ts(spark, sf_dir):
    records = parse_lines(login_lines(spark, sf_dir), OPEN)
    login_ok = F.col("reject").isNull() | (F.col("reject") == "logout")
    return keep(records, login_ok, [*RECORD_COLUMNS, "reject"]).select(
        "employee_id",
        F.col("logout").cast("string").alias("logout"),
        F.col("reject").isNotNull().alias("bad_logout"),
    )


def drop_malformed_open(spark, sf_dir):
    return _as_text(login_records(login_lines(spark, sf_dir), OPEN))


def drop_malformed_closed(spark, sf_dir):
    return _as_text(login_records(login_lines(spark, sf_dir), CLOSED))


def rejects_open(spark, sf_dir):
    return reject_counts(login_lines(spark, sf_dir), OPEN)


def rejects_closed(spark, sf_dir):
    return reject_counts(login_lines(spark, sf_dir), CLOSED)


def first_login(spark, sf_dir):
    firsts = first_logins(login_records(login_lines(spark, sf_dir), OPEN))
    return firsts.select("employee_id", F.col("first_login").cast("string").alias("first_login"))


def _last(spark, sf_dir, mode):
    lasts = last_logouts(login_records(login_lines(spark, sf_dir), mode))
    return lasts.select("employee_id", F.col("last_logout").cast("string").alias("last_logout"))


def last_logout_nullable(spark, sf_dir):
    return _last(spark, sf_dir, OPEN)


def last_logout_closed(spark, sf_dir):
    return _last(spark, sf_dir, CLOSED)


def carry_attributes(spark, sf_dir):
    return carried_attributes(login_records(login_lines(spark, sf_dir), OPEN))


def login_summary_open(spark, sf_dir):
    return login_summary(login_records(login_lines(spark, sf_dir), OPEN))


def login_summary_closed(spark, sf_dir):
    return login_summary(login_records(login_lines(spark, sf_dir), CLOSED))


def format_csv_line(spark, sf_dir):
    return to_lines(login_summary_open(spark, sf_dir))


def header_union(spark, sf_dir):
    header = literal_lines(spark, ",".join(CSV_HEADER))
    return union_lines(header, format_csv_line(spark, sf_dir))


def csv_round_trip(spark, sf_dir):
    """The CSV job, and its output read back."""
    path = _written_lines(spark, sf_dir)
    out = fresh_folder(spark, "csv_round_trip")
    login_summary_csv(spark, path, out)
    schema = ", ".join(f"{name} string" for name in CSV_HEADER)
    found = spark.read.schema(schema).option("header", True).option("escape", '"').csv(out)
    return found.select(*[F.coalesce(name, F.lit("")).alias(name) for name in CSV_HEADER])


def _fresh_table(spark: SparkSession, name: str) -> str:
    """Name of a table that does not exist, in a schema in the shared folder."""
    schema = "punchcard_" + spark.sparkContext.applicationId.replace("-", "_")
    location = shared_folder(spark, "tables")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{location}'")
    return f"{schema}.{name}_{uuid.uuid4().hex}"


def table_append(spark, sf_dir):
    """The same summary appended twice: every row is there twice."""
    table = _fresh_table(spark, "appended")
    for _ in range(2):
        append_summary(login_summary_closed(spark, sf_dir), table)
    return spark.table(table).select(*SUMMARY_COLUMNS)


def table_job_fixed(spark, sf_dir):
    """The table job called with its paths."""
    path = _written_records(spark, sf_dir)
    table = _fresh_table(spark, "fixed")
    login_summary_table(spark, path, table)
    return spark.table(table).select(*SUMMARY_COLUMNS)


def table_job_parameters(spark, sf_dir):
    """The table job called by its command line, twice on one output, as on two days."""
    out = fresh_folder(spark, "table_job_parameters")
    for _ in range(2):
        table_job.main(
            ["--input_csv_file", _written_records(spark, sf_dir), "--output_path", out]
        )
    return spark.read.parquet(out).select(*SUMMARY_COLUMNS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in [
        scan_lines,
        scan_skip_first,
        split_fields,
        drop_header_prefix,
        arity_open,
        arity_closed,
        parse_ts,
        parse_optional_ts,
        drop_malformed_open,
        drop_malformed_closed,
        rejects_open,
        rejects_closed,
        first_login,
        last_logout_nullable,
        last_logout_closed,
        carry_attributes,
        login_summary_open,
        login_summary_closed,
        format_csv_line,
        header_union,
        csv_round_trip,
        table_append,
        table_job_fixed,
        table_job_parameters,
    ]
}
