from punchcard.sinks.csv import CSV_HEADER, write_summary_csv
from punchcard.sinks.table import append_summary, append_summary_files, check_catalog

__all__ = [
    "CSV_HEADER",
    "append_summary",
    "append_summary_files",
    "check_catalog",
    "write_summary_csv",
]
