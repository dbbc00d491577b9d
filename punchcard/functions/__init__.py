"""Column expressions; all of them stay inside the JVM."""

from punchcard.functions.text import (
    csv_fields,
    csv_line,
    is_header,
    raw_fields,
    strip,
    strip_line_end,
    unquote,
)
from punchcard.functions.times import format_timestamp, parse_timestamp

__all__ = [
    "csv_fields",
    "csv_line",
    "format_timestamp",
    "is_header",
    "parse_timestamp",
    "raw_fields",
    "strip",
    "strip_line_end",
    "unquote",
]
