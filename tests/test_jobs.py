import csv
import random
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException, PySparkException

import model
from punchcard import login_summary_csv, login_summary_table
from punchcard.plans import table_job
from punchcard.plans.shared import shared_folder
from punchcard.sinks import CSV_HEADER, append_summary, check_catalog, write_summary_csv
from test_records import random_lines

HEADER = "EmployeeID,Name,Department,LoginTime,LogoutTime"
COLUMNS = "employee_id string, name string, department string, first_login string, last_logout string"


def write_files(folder, files, header=HEADER):
    folder.mkdir()
    for number, lines in enumerate(files):
        text = "\n".join([header, *lines]) + "\n"
        (folder / f"day{number}.csv").write_text(text, encoding="utf-8", newline="")
    return str(folder)


def read_parts(folder):
    """Rows of all parts, and the header of each."""
    headers, rows = [], []
    for part in sorted(Path(folder).glob("part-*.csv")):
        with part.open(encoding="utf-8", newline="") as handle:
            header, *body = csv.reader(handle)
        headers.append(header)
        rows += body
    return headers, rows


def split_in(lines, count):
    return [lines[i::count] for i in range(count)]


def test_csv_job(spark, tmp_path):
    lines = random_lines(4_000, seed=5)
    path = write_files(tmp_path / "in", split_in(lines, 3))
    counts = login_summary_csv(spark, path, str(tmp_path / "out"))
    headers, rows = read_parts(tmp_path / "out")
    assert headers and all(header == CSV_HEADER for header in headers)
    assert {row[0]: tuple(row[1:]) for row in rows} == model.summary(lines, "open")
    assert len(rows) == len(model.summary(lines, "open"))
    kept = sum(model.record(line, "open") is not None for line in lines)
    dropped = sum(n for reason, n in counts.items() if reason != "lines")
    assert counts["lines"] == len(lines) + 3 and counts["lines"] - dropped == kept


def test_csv_job_replaces_its_output(spark, tmp_path):
    path = write_files(tmp_path / "in", [["E1,A,B,2025-01-01 08:00:00,"]])
    for _ in range(2):
        login_summary_csv(spark, path, str(tmp_path / "out"))
    assert read_parts(tmp_path / "out")[1] == [["E1", "A", "B", "2025-01-01 08:00:00", ""]]


def test_csv_job_with_header_only(spark, tmp_path):
    path = write_files(tmp_path / "in", [[]])
    login_summary_csv(spark, path, str(tmp_path / "out"))
    headers, rows = read_parts(tmp_path / "out")
    assert rows == [] and all(header == CSV_HEADER for header in headers)


def test_csv_job_can_fail_on_long_lines(spark, tmp_path):
    path = write_files(tmp_path / "in", [["E1,A,B,2025-01-01 08:00:00,,more"]])
    with pytest.raises(PySparkException, match="more than 5 fields"):
        login_summary_csv(spark, path, str(tmp_path / "out"), fail_on_extra=True)


def test_csv_sink_keeps_text(spark, tmp_path):
    rows = [
        ("", "", "", "", ""),
        (" E1 ", 'Ann "A" Lee', "Ops, north", "2025-01-01 08:00:00", ""),
        ("E2", "back\\slash", "\ttab\t", "x", '"'),
        ("#3", "'", "漢字", "\\\"", "a\rb"),
    ]
    write_summary_csv(spark.createDataFrame(rows, COLUMNS), str(tmp_path / "out"))
    _, found = read_parts(tmp_path / "out")
    assert sorted(map(tuple, found)) == sorted(rows)


def closed_lines(files):
    return [line for lines in files for line in lines]


def test_table_job_appends(spark, tmp_path):
    files = split_in(random_lines(3_000, seed=6), 2)
    # An odd header: only its place drops it.
    path = write_files(tmp_path / "in", files, header="E0,X,Y,2020-01-01 00:00:00,2020-01-01 01:00:00")
    expected = sorted((k, *v) for k, v in model.summary(closed_lines(files), "closed").items())
    spark.sql("DROP TABLE IF EXISTS job_rows")
    login_summary_table(spark, path, "job_rows")
    table = spark.table("job_rows")
    assert [(f.name, f.dataType.simpleString()) for f in table.schema] == [
        (name, "string")
        for name in ["employee_id", "name", "department", "first_login", "last_logout"]
    ]
    assert sorted(tuple(r) for r in table.collect()) == expected
    login_summary_table(spark, path + "/day*.csv", "job_rows")
    assert sorted(tuple(r) for r in spark.table("job_rows").collect()) == sorted(expected * 2)


def test_command_refuses_a_table_that_would_be_lost(spark, tmp_path, monkeypatch):
    path = write_files(tmp_path / "in", [["E1,A,B,2025-01-01 08:00:00,2025-01-01 09:00:00"]])
    arguments = ["--input_csv_file", path + "/", "--output_table", "lost_rows"]
    with pytest.raises(ValueError, match="catalogImplementation"):
        table_job.main(arguments)
    assert not spark.catalog.tableExists("lost_rows")
    for table in ("cat.db.rows", "`cat`.db.`the rows`"):
        check_catalog(spark, table)
    with pytest.raises(ValueError):
        check_catalog(spark, "spark_catalog.db.rows")
    with pytest.raises(ValueError):
        login_summary_table(spark, path)


LAUNCH = """
import sys
from pyspark.sql import SparkSession
SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from punchcard.plans import table_job
table_job.main(sys.argv[1:])
"""


def test_two_launches_append(tmp_path):
    """Two processes, as on two days: every row is there twice."""
    lines = ["E1,A,B,2025-01-01 08:00:00,2025-01-01 09:00:00", "E2,A,B,x,y"]
    path = write_files(tmp_path / "in", [lines])
    out = str(tmp_path / "out")
    for _ in range(2):
        subprocess.run(
            [sys.executable, "-c", LAUNCH, "--input_csv_file", path + "/", "--output_path", out],
            check=True,
            cwd=Path(__file__).resolve().parent.parent,
            timeout=120,
        )
    rows = pq.read_table(out).to_pylist()
    assert [r["employee_id"] for r in rows] == ["E1", "E1"] and rows[0] == rows[1]


def test_line_counts_add_up(spark, tmp_path):
    record = "E1,A,B,2025-01-01 08:00:00,2025-01-01 09:00:00"
    header = "EmployeeID,Name,Department,LoginTime,LogoutTime"
    files = {
        "a.csv": [record, "", "  ", record, "short,line", header, "E2,A,B,x,y", "E2,A,B,2025-01-01 08:00:00,"],
        "b.csv": ["", "", record, ""],
        "c.csv": ["first"],
        "d.csv": [],
    }
    (tmp_path / "in").mkdir()
    for name, lines in files.items():
        (tmp_path / "in" / name).write_text("".join(f"{line}\n" for line in lines))
    path = str(tmp_path / "in")
    closed = login_summary_table(spark, path, out_dir=str(tmp_path / "table"))
    assert closed == {
        "lines": 13,
        "rejected_first": 3,
        "rejected_header": 1,
        "rejected_fields": 5,
        "rejected_login": 1,
        "rejected_logout": 1,
    }
    opened = login_summary_csv(spark, path, str(tmp_path / "out"))
    kept = [model.record(line, "open") for lines in files.values() for line in lines]
    assert opened["lines"] == 13
    assert opened["lines"] - sum(n for k, n in opened.items() if k != "lines") == sum(
        found is not None for found in kept
    )
    rest = [line for name in files for line in files[name][1:]]
    kept = sum(model.record(line, "closed") is not None for line in rest)
    assert closed["lines"] - sum(n for k, n in closed.items() if k != "lines") == kept == 2


def test_append_needs_a_fitting_table(spark):
    spark.sql("DROP TABLE IF EXISTS other_rows")
    spark.sql("CREATE TABLE other_rows (employee_id string, name string) USING parquet")
    summary = spark.createDataFrame([("E1", "a", "b", "c", "d")], COLUMNS)
    with pytest.raises(AnalysisException):
        append_summary(summary, "other_rows")


@pytest.mark.parametrize(
    "path,table,good",
    [
        ("s3://b/day.csv", "sums", True),
        ("/data/", "db.sums", True),
        ("/data/2025-*", "cat.db.sums", True),
        ("/data/day.csv", "`my cat`.db.sums", True),
        ("/data/day.txt", "sums", False),
        (".csv", "sums", False),
        ("/data/day.csv", "a.b.c.d", False),
        ("/data/day.csv", "", False),
        ("/data/day.csv", "a..b", False),
        ("/data/day.csv", "sums; drop", False),
    ],
)
def test_arguments(path, table, good, capsys):
    arguments = ["--input_csv_file", path, "--output_table", table]
    if good:
        options = table_job.parse_arguments(arguments)
        assert (options.input_csv_file, options.output_table) == (path, table)
    else:
        with pytest.raises(SystemExit):
            table_job.parse_arguments(arguments)


def test_arguments_are_required(capsys):
    for missing in ([], ["--input_csv_file", "a.csv"], ["--output_table", "t"]):
        with pytest.raises(SystemExit):
            table_job.parse_arguments(missing)


def test_shared_folder_is_the_sessions(spark):
    assert shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_hot_key(spark, tmp_path):
    """A third of all lines on one id: each task sends one row for it."""
    draw = random.Random(7)
    lines = [
        f"E{7 if i % 3 == 0 else draw.randint(10, 99)},N,D{i},2025-01-{1 + i % 28:02d} 08:00:00,"
        for i in range(30_000)
    ]
    path = write_files(tmp_path / "in", split_in(lines, 4))
    login_summary_csv(spark, path, str(tmp_path / "out"))
    _, rows = read_parts(tmp_path / "out")
    assert {row[0]: tuple(row[1:]) for row in rows} == model.summary(lines, "open")


def test_unset_shared_folder(spark):
    """One machine takes a folder in the warehouse; a cluster has to name one."""

    class Conf(dict):
        def set(self, key, value):
            self[key] = value

    def session(master):
        context = SimpleNamespace(master=master, applicationId="app")
        conf = Conf({"spark.sql.warehouse.dir": "/w"})
        return SimpleNamespace(conf=conf, sparkContext=context)

    assert shared_folder(session("local[2]"), "x") == "/w/_scratch/punchcard/app/x"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"), "x")
