"""What each query must give, in SQL over ``lineitem``.

The header line and its prefix are fixed values. Nothing here parses: the kind of each line decides its fields, whether it counts
and what its values are.
"""

from __future__ import annotations

_LINES = """
sessions AS (
  SELECT
    CASE l_linenumber
      WHEN 1 THEN CASE l_returnflag
        WHEN 'A' THEN 'plain' WHEN 'N' THEN 'longer_quoted' ELSE 'longer' END
      WHEN 2 THEN CASE l_linestatus WHEN 'O' THEN 'open' ELSE 'spaces' END
      WHEN 3 THEN CASE l_returnflag
        WHEN 'A' THEN 'header' WHEN 'N' THEN 'header_like' ELSE 'quoted_header_like' END
      WHEN 4 THEN CASE l_returnflag
        WHEN 'A' THEN 'bad_login' WHEN 'N' THEN 'bad_logout' ELSE 'no_login' END
      WHEN 5 THEN CASE l_returnflag
        WHEN 'A' THEN 'short' WHEN 'N' THEN 'long' ELSE 'blank' END
      WHEN 6 THEN CASE l_returnflag
        WHEN 'A' THEN 'padded' WHEN 'N' THEN 'doubled_quotes' ELSE 'empty_id' END
      ELSE CASE l_returnflag
        WHEN 'A' THEN 'loose' WHEN 'N' THEN 't_separator' ELSE 'text_after_quote' END
    END AS kind,
    CAST(l_suppkey AS VARCHAR) AS k,
    'Dept ' || l_returnflag AS dept,
    l_shipdate + to_seconds(CAST(floor(l_extendedprice) AS BIGINT)) AS login,
    l_shipdate + to_seconds(CAST(floor(l_extendedprice) AS BIGINT)
                            + CAST(l_quantity * 600 AS BIGINT)) AS logout
  FROM lineitem
),
texts AS (
  SELECT *,
    strftime(login, '%Y-%m-%d %H:%M:%S') AS login_usual,
    strftime(logout, '%Y-%m-%d %H:%M:%S') AS logout_usual,
    strftime(login, '%Y-%-m-%-d  %-H:%-M:%-S') AS login_loose,
    strftime(logout, '%Y-%-m-%-d  %-H:%-M:%-S') AS logout_loose
  FROM sessions
),
fields AS (
  SELECT kind, dept, login, logout, login_usual,
    CASE kind WHEN 'blank' THEN 1 WHEN 'short' THEN 4 WHEN 'long' THEN 6
              WHEN 'longer' THEN 8 WHEN 'longer_quoted' THEN 8 ELSE 5 END AS n,
    CASE WHEN kind = 'header' THEN 'EmployeeID'
         WHEN kind IN ('header_like', 'quoted_header_like') THEN 'EmployeeID' || k
         WHEN kind = 'empty_id' THEN ''
         WHEN kind = 'blank' THEN '  '
         ELSE 'E' || k END AS id,
    CASE kind WHEN 'header' THEN 'Name'
              WHEN 'plain' THEN 'Worker ' || k
              WHEN 'longer' THEN 'Worker ' || k
              WHEN 'doubled_quotes' THEN 'Worker "' || k || '"'
              WHEN 'text_after_quote' THEN 'Workers ' || k
              WHEN 'blank' THEN NULL
              ELSE 'Worker, ' || k END AS name,
    CASE kind WHEN 'header' THEN 'Department' WHEN 'blank' THEN NULL ELSE dept END AS department,
    CASE kind WHEN 'header' THEN 'LoginTime'
              WHEN 'blank' THEN NULL
              WHEN 'bad_login' THEN 'not-a-time'
              WHEN 'no_login' THEN ''
              WHEN 'padded' THEN ' ' || login_usual
              WHEN 'loose' THEN login_loose
              WHEN 't_separator' THEN replace(login_usual, ' ', 'T')
              ELSE login_usual END AS login_text,
    CASE kind WHEN 'header' THEN 'LogoutTime'
              WHEN 'blank' THEN NULL
              WHEN 'short' THEN NULL
              WHEN 'open' THEN ''
              WHEN 'spaces' THEN '  '
              WHEN 'bad_logout' THEN logout_usual || '.5'
              WHEN 'padded' THEN logout_usual || chr(9)
              WHEN 'loose' THEN logout_loose
              ELSE logout_usual END AS logout_text
  FROM texts
),
opened AS (
  SELECT id, name, department, login,
    CASE WHEN kind NOT IN ('open', 'spaces') THEN logout END AS logout
  FROM fields
  WHERE kind IN ('plain', 'open', 'spaces', 'quoted_header_like', 'padded',
                 'doubled_quotes', 'empty_id', 'loose', 'text_after_quote')
),
closed AS (
  SELECT id, name, department, login, logout
  FROM fields
  WHERE kind IN ('plain', 'quoted_header_like', 'long', 'longer', 'longer_quoted',
                 'doubled_quotes',
                 'empty_id', 'loose', 'text_after_quote')
)"""

_TIME = "'%Y-%m-%d %H:%M:%S'"
_FIVE = """id AS employee_id, name, department, login_text, logout_text"""
_RAW = """
    CASE kind
      WHEN 'blank' THEN '  '
      WHEN 'header' THEN 'EmployeeID,Name,Department,LoginTime,LogoutTime'
      ELSE CASE WHEN kind = 'quoted_header_like' THEN '"' || id || '"' ELSE id END || ','
        || CASE kind WHEN 'plain' THEN name WHEN 'longer' THEN name
                     WHEN 'doubled_quotes' THEN '"' || replace(name, '"', '""') || '"'
                     WHEN 'text_after_quote' THEN '"Worker"' || substr(name, 7)
                     ELSE '"' || name || '"' END
        || ',' || department || ',' || login_text || coalesce(',' || logout_text, '')
        || CASE kind WHEN 'long' THEN ',more' WHEN 'longer' THEN ',more,of,it'
                     WHEN 'longer_quoted' THEN ',more,"of, it",x' ELSE '' END
    END"""


def _with(select: str, more: str = "") -> str:
    return f"WITH {_LINES.strip()}{more}\n{select.strip()}"


def _records(source: str) -> str:
    return _with(f"""
SELECT id AS employee_id, name, department,
  strftime(login, {_TIME}) AS login, strftime(logout, {_TIME}) AS logout
FROM {source}""")


def _summary(source: str) -> str:
    return f"""
SELECT id AS employee_id,
  arg_min(name, (login, name, department)) AS name,
  arg_min(department, (login, name, department)) AS department,
  strftime(min(login), {_TIME}) AS first_login,
  coalesce(strftime(max(logout), {_TIME}), '') AS last_logout
FROM {source} GROUP BY id"""


# The written records: those of mode open with their ids, and with others that start
# with B. The prefix rule drops ids that were quoted before and start with the prefix.
_REWRITTEN = """,
written AS (
  SELECT * FROM opened WHERE NOT starts_with(id, 'EmployeeID')
  UNION ALL
  SELECT 'B' || id, name, department, login, logout FROM opened
),
rewritten AS (SELECT * FROM written WHERE logout IS NOT NULL)"""

_SUMMARY_OPEN = f""",
summary AS ({_summary("opened")}
)"""
_SUMMARY_LINE = """
SELECT employee_id || ',' || name || ',' || department || ',' || first_login || ','
  || last_logout AS value FROM summary"""


def _rejects(fields: str, login: str, logout: str) -> str:
    return _with(f"""
SELECT CASE WHEN kind IN ('header', 'header_like') THEN 'header'
            WHEN kind IN ({fields}) THEN 'fields'
            WHEN kind IN ({login}) THEN 'login'
            WHEN kind IN ({logout}) THEN 'logout'
            ELSE 'kept' END AS reason,
  count(*) AS line_count
FROM fields GROUP BY 1""")


ORACLE: dict[str, str] = {
    "scan_lines": _with(f"SELECT {_FIVE} FROM fields WHERE n = 5"),
    "scan_skip_first": _with(
        f"""
SELECT id AS employee_id, name, department, strftime(login, {_TIME}) AS login_text,
  coalesce(strftime(logout, {_TIME}), '') AS logout_text
FROM (
  SELECT * FROM opened UNION ALL SELECT 'B' || id, name, department, login, logout FROM opened
)"""
    ),
    "split_fields": _with(f"SELECT n AS field_count, {_FIVE} FROM fields"),
    "drop_header_prefix": _with(
        f"SELECT {_RAW} AS value FROM fields WHERE kind NOT IN ('header', 'header_like')"
    ),
    "arity_open": _with(f"SELECT {_FIVE} FROM fields WHERE n = 5"),
    "arity_closed": _with(f"SELECT {_FIVE} FROM fields WHERE n >= 5"),
    "parse_ts": _with("""
SELECT id AS employee_id, login_text,
  CASE WHEN kind NOT IN ('header', 'blank', 'bad_login', 'no_login', 't_separator', 'padded')
       THEN login_usual END AS as_it_stands,
  CASE WHEN kind NOT IN ('header', 'blank', 'bad_login', 'no_login', 't_separator')
       THEN login_usual ELSE '' END AS stripped
FROM fields"""),
    "parse_optional_ts": _with(f"""
SELECT id AS employee_id,
  CASE WHEN kind NOT IN ('open', 'spaces', 'bad_logout')
       THEN strftime(logout, {_TIME}) END AS logout,
  kind = 'bad_logout' AS bad_logout
FROM fields
WHERE n = 5 AND kind NOT IN ('header', 'header_like', 'bad_login', 'no_login', 't_separator')"""),
    "drop_malformed_open": _records("opened"),
    "drop_malformed_closed": _records("closed"),
    "rejects_open": _rejects(
        "'short', 'long', 'longer', 'longer_quoted', 'blank'", "'bad_login', 'no_login', 't_separator'", "'bad_logout'"
    ),
    "rejects_closed": _rejects(
        "'short', 'blank'",
        "'bad_login', 'no_login', 't_separator', 'padded'",
        "'bad_logout', 'open', 'spaces'",
    ),
    "first_login": _with(
        f"SELECT id AS employee_id, strftime(min(login), {_TIME}) AS first_login "
        "FROM opened GROUP BY id"
    ),
    "last_logout_nullable": _with(
        f"SELECT id AS employee_id, strftime(max(logout), {_TIME}) AS last_logout "
        "FROM opened GROUP BY id"
    ),
    "last_logout_closed": _with(
        f"SELECT id AS employee_id, strftime(max(logout), {_TIME}) AS last_logout "
        "FROM closed GROUP BY id"
    ),
    "carry_attributes": _with("""
SELECT id AS employee_id,
  arg_min(name, (login, name, department)) AS name,
  arg_min(department, (login, name, department)) AS department
FROM opened GROUP BY id"""),
    "login_summary_open": _with(_summary("opened")),
    "login_summary_closed": _with(_summary("closed")),
    "format_csv_line": _with(_SUMMARY_LINE, _SUMMARY_OPEN),
    "header_union": _with(
        "SELECT 'EmployeeID,Name,Department,FirstLoginTime,LastLogoutTime' AS value "
        f"UNION ALL {_SUMMARY_LINE.strip()}",
        _SUMMARY_OPEN,
    ),
    "csv_round_trip": _with(
        'SELECT employee_id AS "EmployeeID", name AS "Name", department AS "Department", '
        'first_login AS "FirstLoginTime", last_logout AS "LastLogoutTime" FROM summary',
        _SUMMARY_OPEN,
    ),
    "table_append": _with(f"{_summary('closed')} UNION ALL {_summary('closed')}"),
    "table_job_fixed": _with(_summary("rewritten"), _REWRITTEN),
    "table_job_parameters": _with(
        f"{_summary('rewritten')} UNION ALL {_summary('rewritten')}", _REWRITTEN
    ),
}
