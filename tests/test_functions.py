import random
from datetime import datetime

import model
import pytest
from pyspark.sql import functions as F

from punchcard.functions import (
    csv_fields,
    csv_line,
    format_timestamp,
    is_header,
    parse_timestamp,
    strip,
    strip_line_end,
)

LINES = [
    "a,b,c,d,e",
    "a,b,c,d",
    "a",
    ",",
    ",,,,",
    "a,,c,,e",
    ' a , "b" ,c,d,e',
    '"a","b,b","c""c",d,e',
    '"","""","""""","""x""",e',
    '"a"b,"c"d"e,"f"g""h,"i""j"k"l,m',
    'a"b,c"d",e""f,g,h',
    '"a,b,c',
    '"a,b""',
    'a,"b,c',
    'a,b,c,d,"',
    '"a" ,b,c,d,e',
    '"',
    '""',
    ',""',
    '"",',
    '"a,b",',
    "a,b\\,c,\\\"d\\\",e,f",
    "é,ü,漢字,🙂,x",
    '"é""🙂",ü,漢字,"x,",y',
    "  ",
    "a,b,c,d,e,f,g,h",
    'a,b,c,d,e,"f,g",h',
]


def fields_of(lines_of, lines):
    rows = lines_of(*lines).select("value", csv_fields(F.col("value")).alias("f")).collect()
    return [(row.value, row.f) for row in rows]


def same_fields(line, found):
    return found == model.split(line)


def test_csv_fields(lines_of):
    for line, found in fields_of(lines_of, LINES):
        assert same_fields(line, found), (line, found, model.split(line))


def test_csv_fields_random(lines_of):
    draw = random.Random(1)
    lines = ["".join(draw.choices('ab,," ', k=draw.randint(1, 14))) for _ in range(20_000)]
    bad = [
        (line, found, model.split(line))
        for line, found in fields_of(lines_of, lines)
        if not same_fields(line, found)
    ]
    assert not bad, bad[:5]


def test_csv_fields_long_field(lines_of):
    line = '"' + 'x""y,' * 20_000 + '",b,c,d,e'
    ((_, found),) = fields_of(lines_of, [line])
    assert found == ['x"y,' * 20_000, "b", "c", "d", "e"]


TIMES = [
    "2025-07-20 09:15:00",
    "2025-7-2 9:5:0",
    "2025-07-20  09:15:00",
    "2025-07-20\t09:15:00",
    "2025-07-20 \xa009:15:00",
    "2025-07- 5 09:15:00",
    "2025- 7-05 09:15:00",
    "2025-07-20 9:15:00",
    "2025-07-20  9:15: 0",
    " 2025-07-20 09:15:00",
    "2025-07-20 09:15:00 ",
    "2025-07-20 09:15:00\r",
    "2025-07-20 09:15:0 ",
    "2025-07-20 09:15:0Z",
    "2025-07-20 09:15",
    "2025-07-20",
    "2025-07-20 09:15:00.5",
    "2025-07-20 09:15:5.",
    "2025-07-20T09:15:00",
    "2025-07-20 09:15:00Z",
    "2025-07-20 09:15:00 Z",
    "2025-07-20 09:15:00+01:00",
    "2025-02-30 09:15:00",
    "2024-02-29 09:15:00",
    "2025-02-29 09:15:00",
    "2025-00-10 09:15:00",
    "2025-13-10 09:15:00",
    "2025-07-00 09:15:00",
    "2025-07-20 24:00:00",
    "2025-07-20 23:60:00",
    "2025-07-20 23:59:60",
    "2025-07-20 23:59:61",
    "25-07-20 09:15:00",
    "12025-07-20 09:15:00",
    "0000-07-20 09:15:00",
    "0000-7-20 09:15:00",
    "0001-01-01 00:00:00",
    "9999-12-31 23:59:59",
    "+025-07-20 09:15:00",
    "-025-07-20 09:15:00",
    "2025-07-2009:15:00",
    "2025/07/20 09:15:00",
    "2025-03-09 02:30:00",
    "2025-11-02 01:30:00",
    "now",
    "epoch",
    "",
    " ",
]


@pytest.mark.parametrize("strip_first", [False, True])
def test_parse_timestamp(lines_of, strip_first):
    parsed = parse_timestamp(F.col("value"), strip_first)
    for row in lines_of(*TIMES).select("value", parsed.alias("time")).collect():
        text = row.value.strip() if strip_first else row.value
        assert row.time == model.time_of(text), row


@pytest.mark.parametrize("strip_first", [False, True])
def test_parse_timestamp_random(lines_of, strip_first):
    draw = random.Random(2)
    texts = []
    for _ in range(20_000):
        text = list(str(datetime.fromtimestamp(draw.randint(0, 2_000_000_000))))
        for _ in range(draw.randint(0, 2)):
            at = draw.randrange(len(text))
            text[at : at + draw.randint(0, 1)] = draw.choice(["", " ", "0", "6", "-", ":", "T"])
        texts.append("".join(text))
    parsed = parse_timestamp(F.col("value"), strip_first)
    for row in lines_of(*texts).select("value", parsed.alias("time")).collect():
        text = row.value.strip() if strip_first else row.value
        assert row.time == model.time_of(text), row


def test_format_timestamp(lines_of):
    time = parse_timestamp(F.col("value"))
    rows = lines_of("2025-03-09 02:30:00", "2025-7-2 9:5:0", "0999-01-01 00:00:00", "x")
    assert [r[0] for r in rows.select(format_timestamp(time)).collect()] == [
        "2025-03-09 02:30:00",
        "2025-07-02 09:05:00",
        "0999-01-01 00:00:00",
        "",
    ]


def test_strip_is_pythons(lines_of):
    spaces = "".join(chr(i) for i in range(0x11000) if chr(i).isspace())
    others = "\x00\x08\x0e\x1b!​⁠﻿"
    (row,) = lines_of(spaces + others + "a b" + others + spaces).select(strip(F.col("value"))).collect()
    assert row[0] == others + "a b" + others


def test_header_line_end_and_join(spark, lines_of):
    rows = lines_of("EmployeeID,Name", "EmployeeID9", "employeeid", " EmployeeID", "x\r\r", "\r", "a\rb")
    found = rows.select(is_header(F.col("value")), strip_line_end(F.col("value"))).collect()
    assert [r[0] for r in found] == [True, True, False, False, False, False, False]
    assert [r[1] for r in found][4:] == ["x", "", "a\rb"]
    pair = spark.createDataFrame([("a", None, "c,d", "")], "w string, x string, y string, z string")
    assert pair.select(csv_line(*[F.col(c) for c in "wxyz"])).first()[0] == "a,,c,d,"
