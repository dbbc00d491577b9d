"""Login lines derived from ``lineitem``, every row of it, one line for each.

The supplier is the employee, the ship date plus the price in seconds the login,
and the quantity in ten-minute steps the length of the session. Line number with
return flag or line status decides the form of the line, so that every rule
about headers, fields, quotes and times meets lines to decide on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_USUAL = 'E<key>,"Worker, <key>",<department>,<login>,<logout>'

# The header line and its prefix. Form of the line by line number and flag (status for line number 2).
_FORMS = {
    "1A": "E<key>,Worker <key>,<department>,<login>,<logout>",
    "1N": 'E<key>,"Worker, <key>",<department>,<login>,<logout>,more,"of, it",x',
    "1R": "E<key>,Worker <key>,<department>,<login>,<logout>,more,of,it",
    "2O": 'E<key>,"Worker, <key>",<department>,<login>,',
    "2F": 'E<key>,"Worker, <key>",<department>,<login>,  ',
    "3A": "EmployeeID,Name,Department,LoginTime,LogoutTime",
    "3N": 'EmployeeID<key>,"Worker, <key>",<department>,<login>,<logout>',
    "3R": '"EmployeeID<key>","Worker, <key>",<department>,<login>,<logout>',
    "4A": 'E<key>,"Worker, <key>",<department>,not-a-time,<logout>',
    "4N": 'E<key>,"Worker, <key>",<department>,<login>,<logout>.5',
    "4R": 'E<key>,"Worker, <key>",<department>,,<logout>',
    "5A": 'E<key>,"Worker, <key>",<department>,<login>',
    "5N": 'E<key>,"Worker, <key>",<department>,<login>,<logout>,more',
    "5R": "  ",
    "6A": 'E<key>,"Worker, <key>",<department>, <login>,<logout>\t',
    "6N": 'E<key>,"Worker ""<key>""",<department>,<login>,<logout>',
    "6R": ',"Worker, <key>",<department>,<login>,<logout>',
    "7A": _USUAL,  # times with single digits, and two blanks before the hour
    "7N": _USUAL,  # T in place of the blank in the login
    "7R": 'E<key>,"Worker"s <key>,<department>,<login>,<logout>',
}


def _form(code: Column) -> Column:
    form = F.lit(_USUAL)
    for key, text in _FORMS.items():
        if text != _USUAL:
            form = F.when(code == key, text).otherwise(form)
    return form


def _loose(time: Column) -> Column:
    return F.replace(F.regexp_replace(time, r"\b0", ""), F.lit(" "), F.lit("  "))


def login_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw lines, in the column ``value``.

    They come out of a generator, so that a filter on them is not pushed below it
    and does not build each line again for each of its conditions.
    """
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    flag = F.when(F.col("l_linenumber") == 2, F.col("l_linestatus")).otherwise(
        F.col("l_returnflag")
    )
    start = F.timestamp_add("SECOND", F.floor("l_extendedprice").cast("int"), "l_shipdate")
    code, login, logout = F.col("code"), F.col("login"), F.col("logout")
    timed = (
        items.withColumns({"code": F.concat("l_linenumber", flag), "start": start})
        .withColumn(
            "end", F.timestamp_add("SECOND", (F.col("l_quantity") * 600).cast("int"), "start")
        )
        .withColumns(
            {"login": F.col("start").cast("string"), "logout": F.col("end").cast("string")}
        )
    )
    line = _form(code)
    for mark, value in {
        "<key>": F.col("l_suppkey").cast("string"),
        "<department>": F.concat(F.lit("Dept "), "l_returnflag"),
        "<login>": F.when(code == "7A", _loose(login))
        .when(code == "7N", F.replace(login, F.lit(" "), F.lit("T")))
        .otherwise(login),
        "<logout>": F.when(code == "7A", _loose(logout)).otherwise(logout),
    }.items():
        line = F.replace(line, F.lit(mark), value)
    return timed.select(F.explode(F.array(line)).alias("value"))
