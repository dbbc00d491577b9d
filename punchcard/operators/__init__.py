from punchcard.operators.lines import to_lines, union_lines
from punchcard.operators.records import (
    CLOSED,
    OPEN,
    keep,
    login_records,
    parse_lines,
    reject_counts,
    split_lines,
    text_records,
)
from punchcard.operators.summary import (
    carried_attributes,
    first_logins,
    last_logouts,
    login_summary,
)

__all__ = [
    "CLOSED",
    "OPEN",
    "carried_attributes",
    "first_logins",
    "keep",
    "last_logouts",
    "login_records",
    "login_summary",
    "parse_lines",
    "reject_counts",
    "split_lines",
    "text_records",
    "to_lines",
    "union_lines",
]
