"""Folders for files that a check query writes and reads back."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A folder of this application under the folder that all machines share.

    That is ``spark.checkpoint.dir``. Where all runs on one machine and it is unset, it is
    set to a folder in the warehouse; a cluster has to name one.
    """
    base = spark.conf.get(_SETTING, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder that all machines share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        spark.conf.set(_SETTING, base)
    return f"{base.rstrip('/')}/punchcard/{spark.sparkContext.applicationId}/{name}"


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A shared folder that no other call gets."""
    return shared_folder(spark, f"{name}-{uuid.uuid4().hex}")
