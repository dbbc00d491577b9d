"""Table sink."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punchcard.operators.summary import SUMMARY_COLUMNS


def check_catalog(spark: SparkSession, table: str) -> None:
    """Refuse a table that no later application could find by its name.

    The session catalog of Spark keeps its tables in memory unless told otherwise.
    """
    parts = re.findall(r"`[^`]+`|\w+", table)
    named = parts[0].strip("`") if len(parts) == 3 else None
    if named not in (None, "spark_catalog"):
        return
    kind = spark.conf.get("spark.sql.catalogImplementation", "in-memory")
    if kind == "in-memory" and not spark.conf.get("spark.sql.catalog.spark_catalog", None):
        raise ValueError(
            f"table {table} would be lost with this application: set "
            "spark.sql.catalogImplementation to hive, or name a catalog set up by "
            "spark.sql.catalog.<name>, or give a path"
        )


def _text_columns(summary: DataFrame) -> DataFrame:
    return summary.select(*[F.col(name).cast("string").alias(name) for name in SUMMARY_COLUMNS])


def append_summary(summary: DataFrame, table: str) -> None:
    """Append the summary to ``table``, which is created if absent.

    The table has five string columns. A second run appends a second time.
    """
    _text_columns(summary).write.mode("append").saveAsTable(table)


def append_summary_files(summary: DataFrame, path: str) -> None:
    """Append the summary as Parquet files to the directory ``path``; needs no catalog."""
    _text_columns(summary).write.mode("append").parquet(path)
