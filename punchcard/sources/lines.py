"""Sources of text lines: DataFrames with the single column ``value``.

Paths may be files, directories or globs; large uncompressed files are split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Characters that Unicode reserves as never used in text.
_NO_SEPARATOR = "\ufffe"
_NO_QUOTE = "\uffff"
# Files named in a filter at most; Spark leaves out the others when it plans the scan.
NAMED_FILES = 1000


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every line of the files. A carriage return alone does not end a line."""
    return spark.read.option("lineSep", "\n").text(path)


def file_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, line_count, first_blank of every file that has a line, from a scan of the text.

    Lines of the first split come in order; the number that tells it is only compared
    within this one scan. Whole numbers are all that is kept for a file, so that Spark
    aggregates by hash and need not sort the lines.
    """
    lines = read_lines(spark, path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("number"),
        _is_blank(F.col("value")).alias("blank"),
    )
    at_start = F.col("start") == 0
    first = F.min(F.when(at_start, F.col("number")))
    first_of_blank = F.min(F.when(at_start & F.col("blank"), F.col("number")))
    return lines.groupBy("file").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.coalesce(first == first_of_blank, F.lit(False)).alias("first_blank"),
    )


def _is_blank(line: Column) -> Column:
    """As the CSV source sees it: nothing above a space character.

    Only a line that begins with such a character has to be looked through.
    """
    return (line < "!") & ~line.rlike(r"[^\x00-\x20]")


def read_lines_after_first(
    spark: SparkSession, path: str | list[str], files: DataFrame | None = None
) -> DataFrame:
    """The lines after the first of each file, whatever the first holds.

    Blank lines may be left out; no rule makes a record of one.

    Only the CSV source can skip a first line, so it reads whole lines here: its
    separator is a character that no text holds, and if one does, the line comes
    back whole as a corrupt record. That source leaves out blank lines, also those at
    the top; a file that begins with a blank line is therefore read as text, whole, as
    its first line gives no record anyway. Up to ``NAMED_FILES`` of these are told apart by
    name, so that each file is opened by one of the two scans only; more, by a join.
    ``files`` is what ``file_lines`` found; if it is not given, the files are looked
    through first.
    """
    lines = (
        spark.read.schema("value string, whole string")
        .option("header", True)
        .option("lineSep", "\n")
        .option("sep", _NO_SEPARATOR)
        .option("quote", _NO_QUOTE)
        .option("columnNameOfCorruptRecord", "whole")
        .csv(path)
    )
    value = F.coalesce("whole", "value").alias("value")
    found = file_lines(spark, path) if files is None else files
    blank = found.filter("first_blank").select("file")
    few = [row.file for row in blank.limit(NAMED_FILES + 1).collect()]
    if not few:
        return lines.select(value)
    whole = read_lines(spark, path)
    if len(few) <= NAMED_FILES:
        # Names in a filter: neither scan opens the files of the other.
        named = F.col("_metadata.file_path").isin(few)
        return lines.filter(~named).select(value).unionByName(whole.filter(named).select("value"))
    after = lines.select(value, F.col("_metadata.file_path").alias("file"))
    whole = whole.select("value", F.col("_metadata.file_path").alias("file"))
    return (
        after.join(blank, "file", "left_anti")
        .unionByName(whole.join(blank, "file", "left_semi"))
        .select("value")
    )


def literal_lines(spark: SparkSession, *lines: str) -> DataFrame:
    """A few given lines, such as a header."""
    return spark.createDataFrame([(line,) for line in lines], "value string")
