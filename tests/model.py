"""The two rules once more in plain Python, to compare with."""

import csv
from datetime import datetime

TIME = "%Y-%m-%d %H:%M:%S"


def split(line):
    rows = list(csv.reader([line]))
    return rows[0] if rows else []


def time_of(text):
    try:
        return datetime.strptime(text, TIME)
    except ValueError:
        return None


def record(line, mode):
    """(id, name, department, login, logout), or None for a dropped line."""
    fields = split(line)
    if line.startswith("EmployeeID") or len(fields) < 5:
        return None
    if mode == "open" and len(fields) > 5:
        return None
    *texts, login, logout = fields[:5]
    if mode == "open":
        login, logout = login.strip(), logout.strip()
    start, end = time_of(login), time_of(logout)
    is_open = mode == "open" and not logout
    if start is None or (end is None and not is_open):
        return None
    return (*texts, start, end)


def summary(lines, mode):
    """Summary rows by id; the earliest record gives name and department."""
    groups = {}
    for line in lines:
        found = record(line, mode)
        if found:
            groups.setdefault(found[0], []).append(found)
    result = {}
    for key, records in groups.items():
        login, name, department = min((r[3], r[1], r[2]) for r in records)
        logouts = [r[4] for r in records if r[4]]
        result[key] = (
            name,
            department,
            str(login),
            str(max(logouts)) if logouts else "",
        )
    return result
