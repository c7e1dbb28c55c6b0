"""Positions in an order, worked out by all tasks at once.

Rows are dealt by ranges of the order, sorted where they are, and stored; a row's number in its part plus the rows of
the parts before it is its position. The driver sees one count a part. Nothing is ranked by a window, so neither a
frame nor a key needs a task of its own. Rows that tie keep the order in which they were scanned; that also splits a value
which most rows share.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quern.sources.shared import stored

#: Spark numbers the rows of a part in the low bits of monotonically_increasing_id.
PART_BITS = 33
#: Rows of a table of parts and keys up to which it is sent to every task.
FEW_KEYS = 10_000


def free(df: DataFrame, name: str) -> str:
    """name, lengthened until df has no column of it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _numbered(df: DataFrame, keys: list[str], *order: str | Column, name: str) -> tuple[DataFrame, DataFrame, str, int]:
    """df, stored in the order of keys and order, with positions and the number of the part; each part's keys with their first position and number of rows there; that number's column; and how many keys parts have, all told."""
    scan, part = free(df, "scan_place"), free(df, "part_place")
    by = [F.col(f"`{c}`").asc_nulls_first() if isinstance(c, str) else c for c in (*keys, *order)]
    dealt = df.withColumn(scan, F.monotonically_increasing_id()).repartitionByRange(*by, F.col(scan)).sortWithinPartitions(*by, F.col(scan))
    placed = stored(dealt.withColumn(part, F.monotonically_increasing_id()).drop(scan), "ordered")
    number, local = F.shiftright(F.col(part), PART_BITS), F.col(part).bitwiseAND(F.lit((1 << PART_BITS) - 1))
    number_, before_, first, count = (free(df, c) for c in ("number", "before", "first_place", "key_rows"))
    tops = placed.groupBy(number.alias(number_), *(F.col(f"`{k}`") for k in keys)).agg(F.min(local).alias(first), F.count("*").alias(count))
    counts = tops.groupBy(F.col(number_).alias("number")).agg(F.sum(count).alias("n"), F.count("*").alias("keys")).orderBy("number").collect()  # a row a part
    numbers, befores, before = [], [], 0
    for r in counts:
        numbers.append(r["number"])
        befores.append(before)
        before += r["n"]
    # From Arrow, as rows of Python would be sent through a Python worker of every core.
    offsets = df.sparkSession.createDataFrame(pa.table({number_: pa.array(numbers, pa.int64()), before_: pa.array(befores, pa.int64())}))

    def moved(rows: DataFrame, to: str, at: Column) -> DataFrame:
        return rows.join(F.broadcast(offsets), number_).withColumn(to, F.col(before_) + at).drop(before_)  # as many rows as there were parts

    return moved(placed.withColumn(number_, number), name, local).drop(part), moved(tops, first, F.col(first)), number_, sum(r["keys"] for r in counts)


def ordered(df: DataFrame, *order: str | Column, name: str = "ordinal") -> DataFrame:
    """df, stored in order, with its position from 0 as a long."""
    placed, _, number, _ = _numbered(df, [], *order, name=name)
    return placed.drop(number)


def same(left: DataFrame, right: DataFrame, keys: dict[str, str]) -> Column:
    """Equality of key columns, nulls equal."""
    return reduce(Column.__and__, (left[f"`{a}`"].eqNullSafe(right[f"`{b}`"]) for a, b in keys.items()))


def within(df: DataFrame, keys: list[str], *order: str | Column, name: str = "ordinal", size: str | None = None) -> DataFrame:
    """df with the position from 0 in the order of the rows that share its keys, and their number if a column is named for it.

    The rows of a key follow each other in the order of keys and order, so a position is the distance to the key's first.
    That is looked up by part and key, so the rows of one key never meet in one task: where they were stored as long as
    parts have few keys, else by a join in which a key is dealt by its parts.
    """
    if not keys:
        placed = ordered(df, *order, name=name)
        return placed if size is None else placed.join(F.broadcast(placed.agg(F.count("*").alias(size))))
    placed, tops, number, n = _numbered(df, keys, *order, name=name)
    names = {k: free(df, f"key_{i}") for i, k in enumerate(keys)}
    number_, first, count = free(placed, "part_number"), free(df, "first_place"), free(df, "key_rows")
    tops = tops.select(F.col(number).alias(number_), *(F.col(f"`{k}`").alias(x) for k, x in names.items()), first, count)
    of_key = Window.partitionBy(*names.values())  # a row for each part that has the key
    known = tops.withColumns({first: F.min(first).over(of_key), count: F.sum(count).over(of_key)})
    joined = placed.join(F.broadcast(known) if n <= FEW_KEYS else known, (placed[number] == known[number_]) & same(placed, known, names))
    joined = joined.withColumn(name, F.col(name) - F.col(first)).drop(number, number_, first, *names.values())
    return joined.withColumnRenamed(count, size) if size else joined.drop(count)


def dense(df: DataFrame, *keys: str, name: str = "dense_rank") -> DataFrame:
    """df with the dense rank from 0 of its keys' values, nulls first. Values are ranked once each and joined back."""
    names = {k: free(df, f"value_{i}") for i, k in enumerate(keys)}
    values = df.select(*(F.col(f"`{k}`").alias(n) for k, n in names.items())).distinct()
    ranked = ordered(values, *names.values(), name=name)
    return df.join(ranked, same(df, ranked, names)).drop(*names.values())


def zipped(left: DataFrame, right: DataFrame, left_order: list[str | Column], right_order: list[str | Column], name: str = "ordinal") -> DataFrame:
    """Rows of two frames side by side by their positions; the longer frame's rest has nulls beside it."""
    a = ordered(left, *left_order, name=name)
    b = ordered(right, *right_order, name=name)
    return a.join(b, name, "full")
