"""Sinks: CSV and JSON exports, partitioned tables, binary files and text reports."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.images import few
from quern.sources.shared import scratch  # noqa: F401  callers take it from here
from quern.sources.tables import SourceNotFound, exists


def write_csv(df: DataFrame, path: str, one_file: bool = True) -> None:
    """CSV with a header. One file is for small tables such as counts; let large ones keep their partitions."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_csv_if_any(df: DataFrame, path: str) -> bool:
    """Written only if there are rows; whether it was."""
    if df.isEmpty():
        return False
    write_csv(df, path)
    return True


def write_summary(df: DataFrame, path: str) -> None:
    """The one row of a summary as a JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_partitioned(df: DataFrame, path: str, *by: str) -> None:
    """Parquet in folders by column values; rows of a folder are dealt over tasks, so a hot one does not meet in one."""
    df.hint("rebalance").write.mode("overwrite").partitionBy(*by).parquet(path)


def write_files(df: DataFrame, root: str, folders: list[str], name: str, content: str = "content") -> DataFrame:
    """One file a row at <root>/<folders...>/<name>, in any store that Arrow opens by the root's address: its path, size, and status.

    A file that is there is kept and counted as such; a failure is a status, not the end of the job. Files are written
    beside their place and then moved, so a task that runs twice leaves whole files.
    """

    def run(batches):
        import pandas as pd
        from pyarrow import fs

        # Hadoop also writes file:/a for file:///a, which Arrow does not open.
        store, base = fs.FileSystem.from_uri("file:///" + root[5:].lstrip("/") if root.startswith("file:") else root)
        for batch in few(batches):
            out = []
            for place, label, body in zip(batch[folders].astype(str).values.tolist(), batch[name].astype(str), batch[content], strict=True):
                folder = "/".join([base.rstrip("/"), *place])
                path, part = f"{folder}/{label}", f"{folder}/.{label}.{uuid.uuid4().hex}.part"
                try:
                    found = store.get_file_info(path)
                    if found.type == fs.FileType.File:
                        out.append((path, found.size, "kept"))
                        continue
                    store.create_dir(folder, recursive=True)
                    with store.open_output_stream(part) as f:
                        f.write(bytes(body))
                    store.move(part, path)
                    out.append((path, len(body), "written"))
                except (OSError, TypeError) as e:
                    out.append((path, 0, f"failed: {e}"))
            yield pd.DataFrame(out, columns=["path", "size", "status"])

    return df.select(*folders, name, content).mapInPandas(run, "path string, size long, status string")


def write_version(df: DataFrame, root: str) -> str:
    """df as the next version of a table, so a step may read the last version and write its own: the folder written.

    Versions are numbered folders of root, from 1; a version counts once its write has succeeded.
    """
    path = f"{root}/v{max(versions(df.sparkSession, root), default=0) + 1:06d}"
    df.write.mode("overwrite").parquet(path)
    return path


def versions(spark: SparkSession, root: str) -> list[int]:
    """The numbers of the whole versions below root, in order; none where there is no such folder."""
    if not exists(spark, root):
        return []
    top = spark._jvm.org.apache.hadoop.fs.Path(root)
    store = top.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath().getName() for s in store.listStatus(top) if s.isDirectory()]
    return sorted(int(n[1:]) for n in found if re.fullmatch(r"v[0-9]+", n) and exists(spark, f"{root}/{n}/_SUCCESS"))


def read_version(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """A version of a table, the last one by default; SourceNotFound where there is none."""
    known = versions(spark, root)
    if not known or number is not None and number not in known:
        raise SourceNotFound(f"{root} has no version" + ("" if number is None else f" {number}"))
    return spark.read.parquet(f"{root}/v{number or known[-1]:06d}")


def render(title: str, sections: dict[str, DataFrame], most: int = 1000) -> str:
    """A text report of small tables, columns aligned; a table of more than ``most`` rows is cut and says so."""
    lines = [title, "=" * len(title)]
    for name, df in sections.items():
        rows = [[("" if v is None else str(v)) for v in r] for r in df.limit(most + 1).collect()]
        width = [max(len(c), *(len(r[i]) for r in rows)) if rows else len(c) for i, c in enumerate(df.columns)]
        lines += ["", name, "-" * len(name), "  ".join(c.ljust(w) for c, w in zip(df.columns, width, strict=True))]
        lines += ["  ".join(v.ljust(w) for v, w in zip(r, width, strict=True)).rstrip() for r in rows[:most]]
        lines += ["... and more"] if len(rows) > most else []
    return "\n".join(lines) + "\n"


def summary_dict(df: DataFrame) -> dict:
    """The one row of a summary as a dictionary."""
    return df.first().asDict(True)


def to_json(df: DataFrame) -> str:
    return json.dumps(summary_dict(df), indent=2, default=str, sort_keys=True)


def with_size_check(df: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """Rows by key against an expected table (key, expected): both numbers and MATCH or MISMATCH."""
    counts = df.groupBy(key).agg(F.count("*").alias("actual"))
    joined = expected.join(counts, key, "full").select(key, "expected", F.coalesce("actual", F.lit(0)).alias("actual"))
    return joined.withColumn("status", F.when(F.col("expected").eqNullSafe(F.col("actual")), "MATCH").otherwise("MISMATCH"))
