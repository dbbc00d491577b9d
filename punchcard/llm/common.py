"""What the operators of this package share: scratch tables, Arrow batches, sampling."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT = "spark.checkpoint.dir"

# Bounds on what one Python batch holds, so that long texts do not fill a worker.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20

# A table with at most this many rows of a few longs may be broadcast.
BROADCAST_ROWS = 500_000


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for ``name`` under the folder all machines share.

    That is ``spark.checkpoint.dir``. Where all runs on one machine and it is unset, it is
    set to a folder in the warehouse; a cluster has to name one.
    """
    base = spark.conf.get(CHECKPOINT, None) or spark.sparkContext.getConf().get(CHECKPOINT)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT} to a folder that all machines share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        spark.conf.set(CHECKPOINT, base)
    return f"{base.rstrip('/')}/punchcard_llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts the lineage."""
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that ``written`` made and nothing reads any more."""
    spark = df.sparkSession
    paths = {file.rpartition("/")[0] for file in df.inputFiles()}
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written_and_swept(df: DataFrame, name: str) -> DataFrame:
    """As ``written``, and the shuffle files of the write go when it is done."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEAN)
    conf.set(_CLEAN, "true")
    try:
        return written(df, name)
    finally:
        conf.set(_CLEAN, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """The text, with a null taken as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def _show_package(spark: SparkSession) -> None:
    """Python workers on this machine import the package from where the driver has it.

    On a cluster it is shipped with the application, and this path tells nothing.
    """
    own = str(Path(__file__).resolve().parents[2])
    variables = spark.sparkContext.environment
    known = variables.get("PYTHONPATH", "").split(":")
    if own not in known:
        variables["PYTHONPATH"] = ":".join([own, *filter(None, known)])


def in_batches(
    df: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """``mapInArrow`` with bounded batches."""
    spark = df.sparkSession
    _show_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(function, schema)


def columns(batch: pa.RecordBatch) -> list[list]:
    return [column.to_pylist() for column in batch.columns]


def batch_of(**arrays: tuple[list, pa.DataType]) -> pa.RecordBatch:
    """A batch of the named (values, type) columns."""
    return pa.RecordBatch.from_arrays(
        [
            values if isinstance(values, pa.Array) else pa.array(values, kind)
            for values, kind in arrays.values()
        ],
        names=list(arrays),
    )


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """True if ``df``, a written table, has at most ``rows`` rows."""
    return df.count() <= rows


def if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, a written table, marked for broadcast if it is small enough; else as it is."""
    return F.broadcast(df) if small_enough(df, rows) else df
