"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset, a temporary one of this process, on a local master only."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if "dir" not in _OWN:
        own = tempfile.TemporaryDirectory(prefix="quern-")
        atexit.register(own.cleanup)
        _OWN["dir"] = f"file://{own.name}"
    return _OWN["dir"]


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name of this application in the shared folder."""
    return f"{shared_dir(spark)}/quern-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """df written to the shared folder and read back: lineage ends at files that outlive any executor."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
