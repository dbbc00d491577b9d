"""The jobs: from paths of raw records to a summary that is stored.

Each returns the line counts of its pass (see ``login_records``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from punchcard.operators.records import CLOSED, OPEN, login_records
from punchcard.operators.summary import login_summary
from punchcard.sinks import append_summary, append_summary_files, write_summary_csv
from punchcard.sources import file_lines, read_lines, read_lines_after_first


def login_summary_csv(
    spark: SparkSession, path: str, out_dir: str, fail_on_extra: bool = False
) -> dict[str, int]:
    """Summary of the files, open sessions included, as CSV in ``out_dir``."""
    counts = Observation()
    records = login_records(read_lines(spark, path), OPEN, counts, fail_on_extra)
    write_summary_csv(login_summary(records), out_dir)
    return counts.get


def login_summary_table(
    spark: SparkSession, path: str, table: str | None = None, out_dir: str | None = None
) -> dict[str, int]:
    """Summary of the closed sessions, appended to ``table`` or to Parquet in ``out_dir``.

    The first line of each file is skipped, even one that holds a record. The counts
    have all lines of the files: ``rejected_first`` are the first ones, and blank lines
    are among ``rejected_fields``.
    """
    if (table is None) == (out_dir is None):
        raise ValueError("give a table or a directory")
    files = file_lines(spark, path).persist()
    try:
        counts = Observation()
        lines = read_lines_after_first(spark, path, files)
        summary = login_summary(login_records(lines, CLOSED, counts))
        if table is not None:
            append_summary(summary, table)
        else:
            append_summary_files(summary, out_dir)
        return _with_skipped(counts.get, files)
    finally:
        files.unpersist()


def _with_skipped(counts: dict[str, int], files: DataFrame) -> dict[str, int]:
    """The counts of a pass with the lines that the source did not hand on."""
    row = files.agg(
        F.coalesce(F.sum("line_count"), F.lit(0)),
        F.count(F.lit(1)),
        F.count_if("first_blank"),
    ).first()
    lines, first, first_blank = row
    # A blank first line was handed on, and counted among the fields.
    skipped_blank = lines - (first - first_blank) - counts["lines"]
    return counts | {
        "lines": lines,
        "rejected_first": first,
        "rejected_fields": counts["rejected_fields"] + skipped_blank - first_blank,
    }
