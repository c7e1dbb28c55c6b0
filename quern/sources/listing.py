"""Every regular file below a folder: also those without a byte, and names that begin with a dot or an underscore.

Spark's own file sources leave such files out. This data source lists folders in tasks: the driver sees the folders right
below the root, and deals them over partitions; each task lists its folders whole. Content is read by a step of its own,
after the listed files have been dealt anew, so a folder that has most of the files is read by all tasks, and a plan that
asks for no content opens no file.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quern.functions import scalars
from quern.functions.images import few

COLUMNS = "relative string, size long"
READ = "content binary, error string"


def opened(root: str) -> tuple[fs.FileSystem, str]:
    """The store of an address, and the path in it. Hadoop also writes file:/a for file:///a, which Arrow does not open."""
    store, base = fs.FileSystem.from_uri("file:///" + root[5:].lstrip("/") if root.startswith("file:") else root)
    return store, base.rstrip("/")


@dataclass
class Folders(InputPartition):
    """Folders to be listed whole, and files that are known already."""

    folders: list[str]
    files: list[tuple[str, int]]


class Reader(DataSourceReader):
    def __init__(self, root: str, parts: int):
        self.root, self.parts = root, parts

    def _listed(self, store: fs.FileSystem, base: str, folder: str, recursive: bool) -> Iterator[fs.FileInfo]:
        return iter(store.get_file_info(fs.FileSelector(f"{base}/{folder}".rstrip("/"), recursive=recursive)))

    def partitions(self) -> list[Folders]:
        store, base = opened(self.root)
        found = sorted(self._listed(store, base, "", False), key=lambda x: x.path)
        names = [x.base_name for x in found if x.type == fs.FileType.Directory]
        here = [(x.base_name, x.size) for x in found if x.type == fs.FileType.File]
        dealt = [Folders(names[i :: self.parts], here if i == 0 else []) for i in range(min(self.parts, max(1, len(names))))]
        return dealt

    def read(self, partition: Folders) -> Iterator[tuple]:
        store, base = opened(self.root)
        yield from partition.files
        for folder in partition.folders:
            for x in self._listed(store, base, folder, True):
                if x.type == fs.FileType.File:
                    yield x.path[len(base) + 1 :] if x.path.startswith(base + "/") else x.path, x.size


class Listing(DataSource):
    """Options: path (the root) and parts (how many tasks list, at most)."""

    @classmethod
    def name(cls) -> str:
        return "quern_listing"

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema) -> Reader:
        return Reader(self.options["path"], int(self.options.get("parts", "64")))


def listed(spark: SparkSession, root: str, parts: int = 64) -> DataFrame:
    """path, folder (the last one a file lies in, null in the root), file_name, extension and size of every regular file."""
    spark.dataSource.register(Listing)
    found = spark.read.format(Listing.name()).option("path", root).option("parts", str(parts)).load()
    split = F.split("relative", "/")
    return found.select(
        F.concat(F.lit(root.rstrip("/") + "/"), F.col("relative")).alias("path"),
        F.when(F.size(split) > 1, F.element_at(split, -2)).alias("folder"),
        F.element_at(split, -1).alias("file_name"),
        scalars.suffix(F.element_at(split, -1)).alias("extension"),
        "size",
    )


def with_content(files: DataFrame, root: str) -> DataFrame:
    """listed() with content and error; a file that cannot be read is an error row."""
    kept = files.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = opened(root)
        for batch in few(batches):
            made = []
            for path in batch["path"]:
                try:
                    with store.open_input_stream(f"{base}/{path[len(root.rstrip('/')) + 1 :]}") as f:
                        made.append((f.read(), None))
                except OSError as e:
                    made.append((None, str(e)))
            yield batch.assign(content=[c for c, _ in made], error=[e for _, e in made])

    ddl = ", ".join(f"`{c}` {files.schema[c].dataType.simpleString()}" for c in kept)
    return files.hint("rebalance").mapInPandas(run, f"{ddl}, {READ}")
