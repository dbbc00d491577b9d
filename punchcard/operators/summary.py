"""Records to one row per employee id.

All are mergeable aggregates: each task reduces its part to one row per id
before the single shuffle, so an id with a third of all records costs no more
there than any other. No group is ever collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punchcard.functions import format_timestamp

SUMMARY_COLUMNS = ["employee_id", "name", "department", "first_login", "last_logout"]


def _earliest() -> Column:
    """Login, name and department of the earliest record.

    Which record gives the name and department is open when records of an id
    differ; both must come from the same one. The least is taken, so that the
    result does not depend on partitioning.
    """
    return F.min(F.struct("login", "name", "department"))


def first_logins(records: DataFrame) -> DataFrame:
    return records.groupBy("employee_id").agg(F.min("login").alias("first_login"))


def last_logouts(records: DataFrame) -> DataFrame:
    """Latest logout; NULL for an id with open sessions only."""
    return records.groupBy("employee_id").agg(F.max("logout").alias("last_logout"))


def carried_attributes(records: DataFrame) -> DataFrame:
    return (
        records.groupBy("employee_id")
        .agg(_earliest().alias("earliest"))
        .select("employee_id", "earliest.name", "earliest.department")
    )


def login_summary(records: DataFrame) -> DataFrame:
    """First login and last logout per id, as text; no logout is empty text."""
    return (
        records.groupBy("employee_id")
        .agg(_earliest().alias("earliest"), F.max("logout").alias("latest"))
        .select(
            "employee_id",
            "earliest.name",
            "earliest.department",
            format_timestamp(F.col("earliest.login")).alias("first_login"),
            format_timestamp(F.col("latest")).alias("last_logout"),
        )
    )
