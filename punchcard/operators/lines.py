"""Rows to text lines, and lines put together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punchcard.functions import csv_line


def to_lines(rows: DataFrame) -> DataFrame:
    """Each row as one comma-joined line, unquoted.

    A value with a comma makes a line that cannot be read back; the CSV sink
    quotes such values.
    """
    return rows.select(csv_line(*[F.col(name) for name in rows.columns]).alias("value"))


def union_lines(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All lines of all inputs, duplicates included, in no given order."""
    for other in others:
        first = first.unionByName(other)
    return first
