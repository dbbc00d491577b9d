"""Times the headline queries; prints one line of JSON.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the local cores. The
login lines of all of ``lineitem`` are written as files first, untimed; each
query then starts from those files, as a job does. The time of a query is the
best of three runs. The queries ``plain_*`` and ``many_ids_*`` read several million
lines, ``COPIES`` of each row of ``lineitem`` with different ids: nearly all without a
quote, and either of many employees with many lines or with an id for each line.
"""

from __future__ import annotations

import json
import os
import shutil
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punchcard import (
    CLOSED,
    OPEN,
    login_records,
    login_summary,
    login_summary_csv,
    login_summary_table,
)
from punchcard.operators import carried_attributes, first_logins, last_logouts, text_records
from punchcard.plans.derived import login_lines
from punchcard.sources import read_lines, read_lines_after_first

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3
COPIES = 8


def session(folder: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("punchcard-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(query: DataFrame) -> None:
    query.write.format("noop").mode("overwrite").save()


def plain_lines(spark: SparkSession, path: str, id_: Column) -> None:
    """Lines without a quote but for one in a hundred, ``id_`` naming the employee."""
    start = F.timestamp_add("SECOND", F.floor("l_extendedprice").cast("int"), "l_shipdate")
    end = F.timestamp_add("SECOND", (F.col("l_quantity") * 600).cast("int"), start)
    name = F.when(F.col("l_partkey") % 100 == 0, F.lit('"Worker, one"')).otherwise("Worker")
    line = F.concat_ws(
        ",", id_, name, F.lit("Dept"), start.cast("string"), end.cast("string")
    )
    (
        spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(COPIES))))
        .select(line.alias("value"))
        .write.text(path)
    )


def headline(spark: SparkSession, folder: str) -> dict[str, Callable[[], object]]:
    path = f"{folder}/lines"
    login_lines(spark, SF_DIR).write.text(path)

    plain, many = f"{folder}/plain", f"{folder}/many_ids"
    plain_lines(spark, plain, F.concat_ws("-", "l_suppkey", "copy"))
    plain_lines(spark, many, F.concat_ws("-", "l_orderkey", "l_linenumber", "copy"))

    def records(mode: str, path: str = path) -> DataFrame:
        read = read_lines if mode == OPEN else read_lines_after_first
        return login_records(read(spark, path), mode)

    return {
        "scan_lines": lambda: run(text_records(read_lines(spark, path), OPEN)),
        "scan_skip_first": lambda: run(text_records(read_lines_after_first(spark, path), CLOSED)),
        "drop_malformed_open": lambda: run(records(OPEN)),
        "drop_malformed_closed": lambda: run(records(CLOSED)),
        "first_login": lambda: run(first_logins(records(OPEN))),
        "last_logout_nullable": lambda: run(last_logouts(records(OPEN))),
        "carry_attributes": lambda: run(carried_attributes(records(OPEN))),
        "login_summary_open": lambda: run(login_summary(records(OPEN))),
        "login_summary_closed": lambda: run(login_summary(records(CLOSED))),
        "csv_job": lambda: login_summary_csv(spark, path, f"{folder}/summary"),
        "table_job": lambda: login_summary_table(spark, path, "summary"),
        "plain_scan": lambda: run(text_records(read_lines(spark, plain), OPEN)),
        "plain_summary_open": lambda: run(login_summary(records(OPEN, plain))),
        "plain_summary_closed": lambda: run(login_summary(records(CLOSED, plain))),
        "many_ids_summary_open": lambda: run(login_summary(records(OPEN, many))),
    }


def main() -> None:
    folder = tempfile.mkdtemp(prefix="punchcard-bench-")
    spark = session(folder)
    seconds: dict[str, float] = {}
    for name, query in headline(spark, folder).items():
        best = float("inf")
        for _ in range(RUNS):
            start = time.perf_counter()
            query()
            best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
    spark.stop()
    shutil.rmtree(folder)
    print(
        json.dumps(
            {
                "metric": "sum of best-of-3 query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")),
            }
        )
    )


if __name__ == "__main__":
    main()
