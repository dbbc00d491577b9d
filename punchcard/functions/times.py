"""Timestamps without a zone: strict parse and plain text form.

``TimestampNTZType`` throughout: a zoned timestamp would move wall-clock times
that do not exist in the session zone, and ``date_format`` converts to one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from punchcard.functions.text import WHITESPACE_CLASS, strip

# Shapes of a time as strptime's "%Y-%m-%d %H:%M:%S" takes it. The
# usual shape has every digit; the lenient one allows single digits, a blank in
# place of a day's first digit, and any white space before the hour.
_USUAL = r"\A\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\z"
_LENIENT = (
    rf"\A\d{{4}}-\d{{1,2}}-(?:\d{{1,2}}| [1-9]){WHITESPACE_CLASS}+"
    r"\d{1,2}:\d{1,2}:\d{1,2}\z"
)
_FIRST_YEAR = "0001"


def parse_timestamp(text: Column, strip_first: bool = False) -> Column:
    """Text to a zone-free timestamp; NULL where it is no valid time.

    The shape is tested before the cast, as the cast alone also takes dates,
    fractions, zones and other separators. ``strip_first`` accepts white space
    around the time; it is paid only by text that is not in the usual shape.
    """
    rest = strip(text) if strip_first else text
    plain = F.replace(
        F.regexp_replace(rest, WHITESPACE_CLASS + "+", " "), F.lit("- "), F.lit("-")
    )
    return F.when(
        text.rlike(_USUAL) & (text >= _FIRST_YEAR), text.try_cast("timestamp_ntz")
    ).when(
        (text != "") & rest.rlike(_LENIENT) & (rest >= _FIRST_YEAR),
        plain.try_cast("timestamp_ntz"),
    )


def format_timestamp(time: Column) -> Column:
    """Zone-free timestamp to ``YYYY-MM-DD HH:MM:SS``; NULL to empty text."""
    return F.coalesce(time.cast("string"), F.lit(""))
