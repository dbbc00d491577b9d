from punchcard.sources import file_lines, literal_lines, read_lines, read_lines_after_first


def put(folder, name, data):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(data.encode("utf-8") if isinstance(data, str) else data)
    return str(folder)


def values(df):
    return sorted(row.value for row in df.collect())


def test_every_line(spark, tmp_path):
    path = put(tmp_path / "in", "a.csv", 'h1\n"x",y\n\n  \nlast')
    put(tmp_path / "in", "b.csv", "h2\ntail\n")
    assert values(read_lines(spark, path)) == ["", "  ", '"x",y', "h1", "h2", "last", "tail"]
    assert values(read_lines(spark, path + "/b*.csv")) == ["h2", "tail"]
    assert values(read_lines(spark, [path + "/a.csv", path + "/b.csv"]))[-1] == "tail"


def test_after_first_of_each_file(spark, tmp_path):
    path = put(tmp_path / "in", "a.csv", 'EmployeeID,Name\n"x",y\nlast')
    put(tmp_path / "in", "b.csv", "E1,data\ntail\n")
    put(tmp_path / "in", "c.csv", "only\n")
    put(tmp_path / "in", "d.csv", "")
    assert values(read_lines_after_first(spark, path)) == ['"x",y', "last", "tail"]


def test_after_first_keeps_lines_whole(spark, tmp_path):
    lines = [
        'a,"b,c',
        '"a","b""c"',
        "  padded\t",
        "\tx ",
        "cr\rinside",
        "#comment",
        "\\escaped\\",
        "\\",
        '"',
        "sep￾inside￾",
        "￾",
        "null",
        "NaN",
        "x" * 200_000,
        "," * 30_000,
        "漢字🙂",
    ]
    path = put(tmp_path / "in", "a.csv", "first\n" + "\n".join(lines) + "\n")
    assert values(read_lines_after_first(spark, path)) == sorted(lines)


def test_line_ends_and_byte_order_mark(spark, tmp_path):
    path = put(tmp_path / "in", "a.csv", b"\xef\xbb\xbfh\r\nx\r\ny")
    assert values(read_lines(spark, path)) == ["h\r", "x\r", "y"]
    assert values(read_lines_after_first(spark, path)) == ["x\r", "y"]


def test_first_line_once_in_split_file(spark, tmp_path):
    count = 20_000
    path = put(tmp_path / "in", "a.csv", "".join(f"line {i}\n" for i in range(count)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = read_lines_after_first(spark, path)
        assert df.rdd.getNumPartitions() > 4
        assert df.count() == count - 1
        assert read_lines(spark, path).distinct().count() == count
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_literal_lines(spark):
    assert values(literal_lines(spark, "b,c", "a")) == ["a", "b,c"]


def test_blank_lines_at_the_top(spark, tmp_path):
    """Only the first line goes, and that is a blank one; other blank lines may stay."""
    path = put(tmp_path / "in", "a.csv", "\n  \nE1,data\nE2,data\n")
    put(tmp_path / "in", "b c.csv", " \nE3,data\n")
    put(tmp_path / "in", "d.csv", "E4,data\n\nE5,data\n")
    put(tmp_path / "in", "e.csv", "\n")
    found = [value for value in values(read_lines_after_first(spark, path)) if value.strip()]
    assert found == ["E1,data", "E2,data", "E3,data", "E5,data"]


def test_file_lines(spark, tmp_path):
    path = put(tmp_path / "in", "a.csv", "\nx\n" + "y\n" * 30_000)
    put(tmp_path / "in", "b.csv", "h\n\n\n")
    put(tmp_path / "in", "c.csv", "")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        rows = file_lines(spark, path).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.file[-5:], r.line_count, r.first_blank) for r in rows) == [
        ("a.csv", 30_002, True),
        ("b.csv", 3, False),
    ]


def test_file_lines_without_a_sort(spark, tmp_path):
    """A file's lines are summed up by hash; a sort of all lines outgrows memory."""
    path = put(tmp_path / "in", "a.csv", "h\n\n \nx\n")
    put(tmp_path / "in", "b.csv", "\x00\x1f \nx\n")
    put(tmp_path / "in", "c.csv", "\tx\n\n")
    put(tmp_path / "in", "d.csv", "\x01\x7f\n\n")
    put(tmp_path / "in", "e.csv", "é\n\n")
    df = file_lines(spark, path)
    assert sorted((r.file[-5:], r.line_count, r.first_blank) for r in df.collect()) == [
        ("a.csv", 4, False),
        ("b.csv", 2, True),
        ("c.csv", 2, False),
        ("d.csv", 2, False),
        ("e.csv", 2, False),
    ]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan


def _opened(df):
    """Number of files that each scan of a plan opens."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan"):
            found.append(node.selectedPartitions().totalNumberOfFiles())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return sorted(found)


def test_each_file_is_opened_by_one_scan(spark, tmp_path):
    path = put(tmp_path / "in", "a b.csv", "\nE1,data\n")
    for i in range(5):
        put(tmp_path / "in", f"c%{i}.csv", f"first\nE{i + 2},data\n")
    df = read_lines_after_first(spark, path)
    assert [v for v in values(df) if v] == [f"E{i},data" for i in range(1, 7)]
    assert _opened(df) == [1, 5]


def test_many_files_with_a_blank_first_line(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("punchcard.sources.lines.NAMED_FILES", 2)
    for i in range(4):
        path = put(tmp_path / "in", f"a{i}.csv", f"\nE{i},data\n")
    put(tmp_path / "in", "b.csv", "first\nE9,data\n")
    found = [value for value in values(read_lines_after_first(spark, path)) if value]
    assert found == ["E0,data", "E1,data", "E2,data", "E3,data", "E9,data"]
