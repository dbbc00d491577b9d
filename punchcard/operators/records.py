"""Lines to login records, under one of two rules.

``OPEN``: a line has exactly five fields, white space around times is ignored,
and a blank logout is a session still open (kept, logout NULL).

``CLOSED``: a line has at least five fields (further ones are ignored), times
are taken as they stand, and both must be valid.

Under both rules header lines are dropped anywhere in the file, and a line with
a bad time is dropped whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from punchcard.functions import (
    is_header,
    parse_timestamp,
    raw_fields,
    strip,
    strip_line_end,
    unquote,
)
from punchcard.functions.text import FIELD_COUNT

OPEN = "open"
CLOSED = "closed"

TEXT_COLUMNS = ["employee_id", "name", "department", "login_text", "logout_text"]
RECORD_COLUMNS = ["employee_id", "name", "department", "login", "logout"]
REJECT_REASONS = ["header", "fields", "login", "logout"]


def check_mode(mode: str) -> None:
    if mode not in (OPEN, CLOSED):
        raise ValueError(f"mode must be {OPEN!r} or {CLOSED!r}, not {mode!r}")


def keep(rows: DataFrame, condition: Column, columns: list[str]) -> DataFrame:
    """None or one row for each: ``columns`` where ``condition`` holds.

    Not a filter, as Catalyst would push that below the columns it reads and so
    compute those, here the whole parse, a second time. A generator stays put.
    """
    return rows.select(F.inline(F.when(condition, F.array(F.struct(*columns)))))


def split_lines(lines: DataFrame) -> DataFrame:
    """Lines to ``is_header``, ``field_count`` and five text columns.

    Columns of missing fields are NULL; ``field_count`` counts all fields.
    """
    line = F.col("value")
    return (
        lines.select(strip_line_end(line).alias("value"))
        .select(is_header(line).alias("is_header"), raw_fields(line).alias("fields"))
        .select(
            "is_header",
            F.size("fields").alias("field_count"),
            *[
                unquote(F.get("fields", F.lit(i))).alias(name)
                for i, name in enumerate(TEXT_COLUMNS)
            ],
        )
    )


def _enough_fields(mode: str) -> Column:
    count = F.col("field_count")
    return count == FIELD_COUNT if mode == OPEN else count >= FIELD_COUNT


def text_records(lines: DataFrame, mode: str) -> DataFrame:
    """The five text columns of lines with a number of fields that ``mode`` takes."""
    check_mode(mode)
    return keep(split_lines(lines), _enough_fields(mode), TEXT_COLUMNS)


def _field_count(mode: str, fail_on_extra: bool) -> Column:
    count = F.col("field_count")
    if mode == OPEN and fail_on_extra:
        too_long = ~F.col("is_header") & (count > FIELD_COUNT)
        message = F.lit(f"line with more than {FIELD_COUNT} fields")
        return F.when(too_long, F.raise_error(message).cast("int")).otherwise(count)
    return count


def _reject(mode: str) -> Column:
    enough = F.coalesce(_enough_fields(mode), F.lit(False))
    no_logout = F.col("logout").isNull()
    if mode == OPEN:
        no_logout = no_logout & (strip(F.col("logout_text")) != "")
    return (
        F.when(F.col("is_header"), "header")
        .when(~enough, "fields")
        .when(F.col("login").isNull(), "login")
        .when(no_logout, "logout")
    )


def parse_lines(lines: DataFrame, mode: str, fail_on_extra: bool = False) -> DataFrame:
    """Every line as a record plus ``reject``: why it is dropped, or NULL.

    ``fail_on_extra`` makes a line of more than five fields fail the query in
    mode ``open``, where it is otherwise rejected.
    """
    check_mode(mode)
    stripped = mode == OPEN
    return (
        split_lines(lines)
        .withColumns(
            {
                "field_count": _field_count(mode, fail_on_extra),
                "login": parse_timestamp(F.col("login_text"), stripped),
                "logout": parse_timestamp(F.col("logout_text"), stripped),
            }
        )
        .select(*RECORD_COLUMNS, _reject(mode).alias("reject"))
    )


def login_records(
    lines: DataFrame,
    mode: str,
    observation: Observation | None = None,
    fail_on_extra: bool = False,
) -> DataFrame:
    """The valid records of the lines: none or one for each.

    With an ``observation`` the same pass counts ``lines`` and, by reason, the
    dropped ones. A stage that runs again after a lost executor may count twice;
    ``reject_counts`` is exact, at the price of its own pass.
    """
    parsed = parse_lines(lines, mode, fail_on_extra)
    if observation is not None:
        reasons = [
            F.count_if(F.col("reject") == reason).alias(f"rejected_{reason}")
            for reason in REJECT_REASONS
        ]
        parsed = parsed.observe(observation, F.count(F.lit(1)).alias("lines"), *reasons)
    return keep(parsed, F.col("reject").isNull(), RECORD_COLUMNS)


def reject_counts(lines: DataFrame, mode: str) -> DataFrame:
    """Number of lines by reason; ``kept`` for the valid ones."""
    reason = F.coalesce("reject", F.lit("kept")).alias("reason")
    return parse_lines(lines, mode).groupBy(reason).agg(F.count(F.lit(1)).alias("line_count"))
