"""CSV sink."""

from __future__ import annotations

from pyspark.sql import DataFrame

from punchcard.operators.summary import SUMMARY_COLUMNS

# The columns of the CSV form, in order.
CSV_HEADER = ["EmployeeID", "Name", "Department", "FirstLoginTime", "LastLogoutTime"]


def write_summary_csv(summary: DataFrame, path: str) -> None:
    """Replace the directory ``path`` by the summary as CSV part files.

    Each part starts with the header. Text is written as it is: quotes are
    doubled, white space is kept and an empty value is nothing between commas.
    """
    (
        summary.select(*SUMMARY_COLUMNS)
        .toDF(*CSV_HEADER)
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
