"""Parquet tables by name, and a typed error for sources that are not there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class SourceNotFound(FileNotFoundError):
    """A source that a plan needs does not exist."""


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, in any store that Spark reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target))


def require(spark: SparkSession, *paths: str) -> None:
    if missing := [p for p in paths if not exists(spark, p)]:
        raise SourceNotFound(", ".join(missing))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def optional(spark: SparkSession, path: str, schema: StructType | str, form: str = "csv") -> DataFrame:
    """A source with a declared schema, or an empty frame of it where the path does not exist."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return csv(spark, path, schema) if form == "csv" else json(spark, path, schema)


def csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header; columns are matched to the declared schema, never inferred."""
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One JSON document a file."""
    return spark.read.schema(schema).option("multiLine", True).json(path)
