"""A manifest kept up to date by deltas: only fingerprints that a delta touches are worked out anew.

A manifest is a folder of numbered versions. Each holds the entries of the fingerprints that it changed, or, after every
``compact_after`` of them, all entries. A fingerprint's entries are those of the last version that has it; an item without
a fingerprint stands alone. A fingerprint that loses its last item is marked as gone. A canonical item may move to one
that comes earlier in scan order, as manifest() itself judges the touched fingerprints.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators import master
from quern.sources import sinks

#: Columns beside an item's: its key, validity of its own, the first version to be read with this one, and whether the key is gone.
OWN = ("entry_key", "own_valid", "first_version", "is_gone")
MADE = ("is_valid", "is_duplicate", "canonical_id", "include_in_master")


def _key() -> Column:
    return F.coalesce(F.concat(F.lit("f:"), F.col("fingerprint")), F.concat(F.lit("id:"), F.col("id").cast("string")))


def layers(spark: SparkSession, root: str) -> list[int]:
    """The versions that make up the manifest now."""
    known = sinks.versions(spark, root)
    if not known:
        return []
    first = sinks.read_version(spark, root, known[-1]).select("first_version").first()["first_version"]
    return [v for v in known if v >= first]


def _current(spark: SparkSession, root: str) -> DataFrame:
    rows = [sinks.read_version(spark, root, v).withColumn("version", F.lit(v)) for v in layers(spark, root)]
    both = reduce(DataFrame.unionByName, rows)
    if len(rows) > 1:
        last = both.groupBy("entry_key").agg(F.max("version").alias("version"))
        both = both.join(last, ["entry_key", "version"], "left_semi")
    return both.where(~F.col("is_gone")).drop("version")


def current(spark: SparkSession, root: str) -> DataFrame:
    """The manifest's entries, as manifest() of all items would give them."""
    return _current(spark, root).drop(*OWN)


def update(root: str, delta: DataFrame, order: list[str], removed: DataFrame | None = None, compact_after: int = 8) -> int | None:
    """Take in new and changed items (by id, each once) and drop removed ones (id): the version written, or None where nothing changes."""
    spark = delta.sparkSession
    items = delta.drop("content").withColumns({"own_valid": F.col("is_valid"), "entry_key": _key()})
    old = layers(spark, root)
    ids = items.select("id")
    if removed is not None:
        ids = ids.unionByName(removed.select("id"))
    ids = ids.distinct()
    if old:
        now = _current(spark, root).drop("first_version", "is_gone")
        keys = items.select("entry_key").unionByName(now.join(ids, "id", "left_semi").select("entry_key")).distinct()
        touched = now.join(keys, "entry_key", "left_semi")
        stay = touched.join(ids, "id", "left_anti").drop(*MADE).withColumn("is_valid", F.col("own_valid"))
        items = items.unionByName(stay)
    made = master.manifest(items, order)
    if old:
        columns = made.columns
        before = touched.select(columns)
        if made.exceptAll(before).isEmpty() and before.exceptAll(made).isEmpty():
            return None
        gone = keys.join(made.select("entry_key").distinct(), "entry_key", "left_anti")
        marks = gone.select(*(F.col(c) if c == "entry_key" else F.lit(None).cast(made.schema[c].dataType).alias(c) for c in columns))
        made = made.withColumn("is_gone", F.lit(False)).unionByName(marks.withColumn("is_gone", F.lit(True)))
    else:
        made = made.withColumn("is_gone", F.lit(False))
        if made.isEmpty():
            return None
    version = max(sinks.versions(spark, root), default=0) + 1
    sinks.write_version(made.withColumn("first_version", F.lit(old[0] if old else version)), root)
    if len(old) + 1 > compact_after:
        whole = _current(spark, root).drop("first_version").withColumn("is_gone", F.lit(False))
        if not whole.isEmpty():
            version += 1
            sinks.write_version(whole.withColumn("first_version", F.lit(version)), root)
    return version
