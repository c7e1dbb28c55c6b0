"""What the corpus operators share: table loading, stored intermediate tables and Arrow row mapping."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Rows handed to a Python kernel at once; bounds what one step holds besides the Arrow batch.
SLICE_ROWS = 512

_OWN: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset, a temporary one on a local master only."""
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


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder as Parquet and read it back.

    Cuts the lineage with files that outlive any executor; a lost executor only costs the running tasks.
    The folder belongs to the application and can be deleted once its results are written.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quern-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    trim_driver(spark)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """name, lengthened until df has no column of it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def drop_stored(df: DataFrame) -> None:
    """Delete the files behind a DataFrame that stored() returned and nothing reads any more."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if f"/quern-{spark.sparkContext.applicationId}/" not in path:
            raise ValueError(f"not a stored table: {path}")
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def return_memory() -> None:
    """Give what a task has freed back to the system, as the worker outlives it."""
    gc.collect()
    trim_memory()


def trim_memory() -> None:
    """return_memory() for tasks that leave no cycles behind, without a look at everything that is kept."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no trim
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def trim_driver(spark: SparkSession) -> None:
    """trim_memory() for the driver: Python, and what its JVM has freed outside the heap.

    Compiling and planning leave some 200 MB in the C library's arenas, of which the threads of many exchanges make
    many; it is not returned by itself, and comes on top of the heap. JVMs without that command keep it.
    """
    trim_memory()
    java, management = spark._jvm.java, spark._jvm.javax.management
    call = next(m for m in java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")  # the server's own class is hidden
    args = spark.sparkContext._gateway.new_array(java.lang.Object, 4)
    args[0], args[1] = management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    with contextlib.suppress(Py4JJavaError):
        call.invoke(java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)


def map_slices(df: DataFrame, schema: pa.Schema, ddl: str | StructType, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], done: Callable[[], None] | None = None) -> DataFrame:
    """mapInArrow over slices of at most SLICE_ROWS rows. make() runs once a task and returns the kernel, done() at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                out = kernel(batch.slice(at, SLICE_ROWS))
                if out is not None and out.num_rows:
                    yield out.cast(schema)
            pa.default_memory_pool().release_unused()
        del kernel
        if done is not None:
            done()
        return_memory()

    return df.mapInArrow(run, ddl)


class Memo(dict):
    """A bounded memo of f by key, of two generations: the older one goes when the newer is full.

    Keys longer than ``longest``, where given, are worked out each time.
    """

    def __init__(self, f: Callable | None, most: int, longest: int | None = None):
        super().__init__()
        self._f, self._most, self._longest, self._old = f, most, longest, {}

    def __missing__(self, key):
        found = self._old.get(key)
        if found is None:
            found = self._f(key)
        if self._longest is None or len(key) <= self._longest:
            self.put(key, found)
        return found

    def find(self, key):
        """What is kept for a key, or None."""
        found = self.get(key)
        if found is None and (found := self._old.get(key)) is not None:
            self.put(key, found)
        return found

    def forget(self) -> None:
        """Drop the older generation."""
        self._old = {}

    def put(self, key, value) -> None:
        if len(self) >= self._most:
            self._old = dict(self)
            self.clear()
        self[key] = value
