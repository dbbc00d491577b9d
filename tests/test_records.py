import random
from datetime import datetime

import model
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation

from punchcard import CLOSED, OPEN, login_records, login_summary, parse_lines
from punchcard.operators import (
    carried_attributes,
    first_logins,
    last_logouts,
    reject_counts,
    split_lines,
)

IN, OUT = "2025-07-20 09:15:00", "2025-07-20 17:00:00"

# line, reject reason in mode open, reject reason in mode closed
CASES = [
    (f"E1,Ann,Ops,{IN},{OUT}", None, None),
    (f"E1,Ann,Ops,{IN},", None, "logout"),
    (f"E1,Ann,Ops,{IN},   ", None, "logout"),
    (f"E1,Ann,Ops,{IN},later", "logout", "logout"),
    (f"E1,Ann,Ops,soon,{OUT}", "login", "login"),
    (f"E1,Ann,Ops,,{OUT}", "login", "login"),
    (f"E1,Ann,Ops, {IN}\t,{OUT}", None, "login"),
    (f"E1,Ann,Ops,{IN},\xa0{OUT} ", None, "logout"),
    (f"E1,Ann,Ops,{IN}", "fields", "fields"),
    (f"E1,Ann,Ops,{IN},{OUT},more", "fields", None),
    (f"E1,Ann,Ops,{IN},{OUT},", "fields", None),
    ("", "fields", "fields"),
    ("   ", "fields", "fields"),
    ("EmployeeID,Name,Department,LoginTime,LogoutTime", "header", "header"),
    (f"EmployeeID9,Ann,Ops,{IN},{OUT}", "header", "header"),
    (f'"EmployeeID9",Ann,Ops,{IN},{OUT}', None, None),
    (f"employeeid9,Ann,Ops,{IN},{OUT}", None, None),
    (f",Ann,Ops,{IN},{OUT}", None, None),
    (f'"",,"",{IN},{OUT}', None, None),
    (f'E1,"Lee, Ann",Ops,{IN},{OUT}', None, None),
    (f'E1,"Ann ""A"" Lee",Ops,{IN},{OUT}', None, None),
    (f'E1,Ann,Ops,"{IN}","{OUT}"', None, None),
    ("E1,Ann,Ops,2025-7-2 9:5:0,2025-7-2 9:5:1", None, None),
    (f"E1,Ann,Ops,{IN}.5,{OUT}", "login", "login"),
    (f"E1,Ann,Ops,{IN},2025-07-20T17:00:00", "logout", "logout"),
    (f"E1,Ann,Ops,2025-02-30 09:15:00,{OUT}", "login", "login"),
    (f"E1,Ann,Ops,{IN},2025-07-20 24:00:00", "logout", "logout"),
    (f"E1,Ann,Ops,{IN},2025-07-20 23:59:60", "logout", "logout"),
    (f"E1,Ann,Ops,{IN},{OUT}\r", None, None),
    (f" E1 , Ann , Ops ,{IN},{OUT}", None, None),
]


@pytest.mark.parametrize("mode", [OPEN, CLOSED])
@pytest.mark.parametrize("line,in_open,in_closed", CASES)
def test_model_cases(mode, line, in_open, in_closed):
    line = line.rstrip("\r")
    reason = in_open if mode == OPEN else in_closed
    assert (model.record(line, mode) is None) == (reason is not None)


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("mode", [OPEN, CLOSED])
def test_cases(spark, lines_of, mode, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        check_cases(lines_of, mode)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def check_cases(lines_of, mode):
    # One partition keeps the order, so rows can be matched by position.
    lines = lines_of(*[case[0] for case in CASES]).coalesce(1)
    parsed = parse_lines(lines, mode).collect()
    for (line, in_open, in_closed), row in zip(CASES, parsed, strict=True):
        reason = in_open if mode == OPEN else in_closed
        assert row.reject == reason, line
        if reason is None:
            assert tuple(row[:5]) == model.record(line.rstrip("\r"), mode), line


def test_mode_is_checked(lines_of):
    with pytest.raises(ValueError):
        login_records(lines_of("x"), "half-open")


def test_fail_on_extra(lines_of):
    good = f"E1,Ann,Ops,{IN},{OUT}"
    header = "EmployeeID,a,b,c,d,e,f"
    kept = login_records(lines_of(good, "a,b", header), OPEN, fail_on_extra=True)
    assert kept.count() == 1
    with pytest.raises(PySparkException, match="more than 5 fields"):
        login_records(lines_of(good, good + ",x"), OPEN, fail_on_extra=True).collect()


@pytest.mark.parametrize("mode", [OPEN, CLOSED])
def test_counts(lines_of, mode):
    lines = lines_of(*[case[0] for case in CASES])
    reasons = [case[1 if mode == OPEN else 2] for case in CASES]
    seen = Observation()
    kept = login_summary(login_records(lines, mode, seen))
    kept.collect()
    expected = {f"rejected_{r}": reasons.count(r) for r in ["header", "fields", "login", "logout"]}
    assert seen.get == {"lines": len(CASES), **expected}
    found = {row.reason: row.line_count for row in reject_counts(lines, mode).collect()}
    assert found == {(r or "kept"): reasons.count(r) for r in set(reasons)}


def random_lines(count, seed):
    draw = random.Random(seed)

    def time():
        text = str(datetime.fromtimestamp(draw.randint(1_700_000_000, 1_700_900_000)))
        kind = draw.random()
        if kind < 0.05:
            return draw.choice([text + ".1", text[:-3], text.replace(" ", "T"), "x", "0" + text])
        if kind < 0.1:
            return draw.choice([" " + text, text + "\t", text.replace(" ", "  "), f'"{text}"'])
        if kind < 0.15:
            return text.replace("-0", "-").replace(":0", ":")
        return text

    lines = []
    for _ in range(count):
        key = draw.randint(0, 400) if draw.random() > 0.33 else 7
        identity = draw.choice([f"E{key}"] * 12 + [f'"E{key}"', "", f'"EmployeeID{key}"'])
        name = draw.choice([f"N{key}", f'"N, {key}"', f'"N ""{key}"""', f" N{key} ", f'N"{key}'])
        fields = [identity, name, f"D{draw.randint(0, 3)}", time(), time()]
        if draw.random() < 0.2:
            fields[4] = draw.choice(["", " ", '""'])
        if draw.random() < 0.03:
            fields = fields[: draw.randint(0, 4)]
        if draw.random() < 0.03:
            fields += ["more"] * draw.randint(1, 3)
        line = ",".join(fields)
        if draw.random() < 0.02:
            line = draw.choice(["EmployeeID,Name", "EmployeeID" + line, "  ", ""])
        lines.append(line)
    return lines


@pytest.mark.parametrize("mode", [OPEN, CLOSED])
def test_random_lines(lines_of, mode):
    lines = random_lines(20_000, seed=3)
    found = {
        row.employee_id: tuple(row[1:])
        for row in login_summary(login_records(lines_of(*lines), mode)).collect()
    }
    assert found == model.summary(lines, mode)


def test_summary_parts_agree(lines_of):
    records = login_records(lines_of(*random_lines(3_000, seed=4)), OPEN).cache()
    whole = {r.employee_id: r for r in login_summary(records).collect()}
    for row in first_logins(records).collect():
        assert whole[row.employee_id].first_login == str(row.first_login)
    for row in last_logouts(records).collect():
        assert whole[row.employee_id].last_logout == str(row.last_logout or "")
    for row in carried_attributes(records).collect():
        assert tuple(whole[row.employee_id][1:3]) == (row.name, row.department)
    records.unpersist()


def test_two_sessions_each(lines_of):
    lines = [
        "EmployeeID,Name,Department,LoginTime,LogoutTime",
        "W1,Ida,Ops,2025-01-06 08:00:00,2025-01-06 12:00:00",
        "W1,Ida,Ops,2025-01-06 13:00:00,2025-01-06 17:30:00",
        "W2,Bo,Lab,2025-01-06 09:30:00,2025-01-06 11:00:00",
        "W2,Bo,Lab,2025-01-06 12:00:00,",
    ]
    expected = [
        ("W1", "Ida", "Ops", "2025-01-06 08:00:00", "2025-01-06 17:30:00"),
        ("W2", "Bo", "Lab", "2025-01-06 09:30:00", "2025-01-06 11:00:00"),
    ]
    for mode in (OPEN, CLOSED):
        rows = login_summary(login_records(lines_of(*lines), mode)).collect()
        assert sorted(tuple(r) for r in rows) == expected


def test_all_open(lines_of):
    records = lines_of(f"E1,Ann,Ops,{IN},", f"E1,Ann,Ops,{OUT}, ")
    rows = login_summary(login_records(records, OPEN)).collect()
    assert [tuple(r) for r in rows] == [("E1", "Ann", "Ops", IN, "")]
    assert login_summary(login_records(records, CLOSED)).collect() == []


def test_plan_parses_once_and_shuffles_once(lines_of, spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n")
    from punchcard.sources import read_lines

    for seen in (None, Observation()):
        df = login_summary(login_records(read_lines(spark, str(tmp_path)), OPEN, seen))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1
        assert plan.count("split(") == 1
        assert plan.count("RLIKE") == 4
        assert "partial_min" in plan and "partial_max" in plan
        assert "Python" not in plan and "Pandas" not in plan


def test_split_is_generated_code(lines_of):
    """No lambda cuts the stage that splits lines and unquotes the fields."""
    plan = split_lines(lines_of("a,b"))._jdf.queryExecution().executedPlan().toString()
    (split,) = [line for line in plan.split("\n") if "regexp_extract_all" in line]
    (unquoted,) = [line for line in plan.split("\n") if "regexp_replace" in line]
    assert split.lstrip(" +-:").startswith("*(") and unquoted.lstrip(" +-:").startswith("*(")
