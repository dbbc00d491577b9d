"""Attendance summaries from raw login records, as Spark DataFrame jobs.

Raw input is delimited text, one session per line: id, name, department, login
time, logout time. Output is one row per id with the first login and the last
logout. Two rules decide which lines count; see ``punchcard.operators.records``.
"""

from punchcard.operators.records import CLOSED, OPEN, login_records, parse_lines
from punchcard.operators.summary import login_summary
from punchcard.plans.jobs import login_summary_csv, login_summary_table

__all__ = [
    "CLOSED",
    "OPEN",
    "login_records",
    "login_summary",
    "login_summary_csv",
    "login_summary_table",
    "parse_lines",
]
