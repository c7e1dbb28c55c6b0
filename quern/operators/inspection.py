"""Inspection of labelled items from several corpora: status counters, class statistics, comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.operators import ordinals

def with_status(items: DataFrame, supported: Column, valid: Column) -> DataFrame:
    """items with status: unsupported, corrupt or valid. What is unsupported is not looked at further."""
    return items.withColumn("status", F.when(~supported, "unsupported").when(~valid, "corrupt").otherwise("valid"))


def _status_counts() -> list[Column]:
    return [F.count("*").alias("total"), *(F.count_if(F.col("status") == s).alias(s) for s in ("valid", "unsupported", "corrupt"))]


def status_counts(items: DataFrame) -> DataFrame:
    """Items by corpus and status, in one pass."""
    return items.groupBy("corpus").agg(*_status_counts())


def class_stats(items: DataFrame, size: str = "n_chars", mode: str = "source") -> DataFrame:
    """Counters, extent of sizes and the distinct modes of valid items, by corpus and class."""
    valid = F.col("status") == "valid"
    return items.groupBy("corpus", "klass").agg(
        *_status_counts(),
        F.min(F.when(valid, F.col(size))).alias("min_size"),
        F.max(F.when(valid, F.col(size))).alias("max_size"),
        F.array_join(F.array_sort(F.collect_set(F.when(valid, F.col(mode)))), ",").alias("modes"),
    )


def corpus_summary(items: DataFrame) -> DataFrame:
    """Per corpus, the spread of its classes' valid counts (population deviation)."""
    counts = items.groupBy("corpus", "klass").agg(F.count_if(F.col("status") == "valid").alias("n"))
    return counts.groupBy("corpus").agg(
        F.count("*").alias("classes"),
        F.sum("n").alias("valid"),
        F.min("n").alias("min_per_class"),
        F.max("n").alias("max_per_class"),
        F.round(F.avg("n"), 6).alias("mean_per_class"),
        F.round(F.coalesce(F.stddev_pop("n"), F.lit(0.0)), 6).alias("std_per_class"),
    )


def compare_counts(items: DataFrame, first: str, second: str, least: int) -> DataFrame:
    """Valid items of the classes both corpora have, with a flag for small ones and a TOTAL row."""
    valid = F.col("status") == "valid"
    by_class = items.groupBy("klass").agg(
        *(F.count_if((F.col("corpus") == c) & valid).alias(n) for c, n in ((first, "first_count"), (second, "second_count"))),
        F.countDistinct(F.when(F.col("corpus").isin(first, second), F.col("corpus"))).alias("corpora"),
    )
    common = by_class.where("corpora = 2").withColumn("combined", F.col("first_count") + F.col("second_count"))
    rolled = common.rollup("klass").agg(F.sum("first_count").alias("first_count"), F.sum("second_count").alias("second_count"), F.sum("combined").alias("combined"), F.grouping("klass").alias("is_total"))
    return rolled.select(
        F.when(F.col("is_total") == 1, "TOTAL").otherwise(F.col("klass")).alias("klass"),
        "first_count",
        "second_count",
        "combined",
        F.when(F.col("is_total") == 1, "").when(F.col("combined") < least, "WARN").otherwise("OK").alias("flag"),
    )


def spread(counts: DataFrame, value: str) -> DataFrame:
    """Sum, extent, mean and sample deviation of a count column."""
    return counts.agg(
        F.sum(value).alias("total"),
        F.min(value).alias("least"),
        F.max(value).alias("most"),
        F.round(F.avg(value), 6).alias("mean"),
        F.round(F.coalesce(F.stddev_samp(value), F.lit(0.0)), 6).alias("std_samp"),
    )


def set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The distinct keys of two frames: only_left, only_right or both."""
    sides = left.select(key).distinct().withColumn("l", F.lit(1)).unionByName(right.select(key).distinct().withColumn("l", F.lit(2)))
    found = sides.groupBy(key).agg(F.sum("l").alias("sides"))
    return found.select(key, F.when(F.col("sides") == 1, "only_left").when(F.col("sides") == 2, "only_right").otherwise("both").alias("side"))


def expectations(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected against actual numbers by label: difference and MATCH or MISMATCH; a missing actual is a mismatch."""
    joined = expected.join(actual, "label", "left")
    return joined.select("label", "expected", "actual", (F.col("actual") - F.col("expected")).alias("difference"), F.when(F.col("actual").eqNullSafe(F.col("expected")), "MATCH").otherwise("MISMATCH").alias("status"))


def first_and_rest(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first n rows and how many more there are (a report)."""
    total = rows.agg(F.count("*").alias("n"))
    return rows.orderBy(*order).limit(n).join(F.broadcast(total)).withColumn("more", F.greatest(F.col("n") - n, F.lit(0))).drop("n")


def ids_by_status(items: DataFrame, status: str) -> DataFrame:
    """The ids of a status by class, in order."""
    return items.groupBy("klass").agg(F.array_join(F.array_sort(F.collect_list(F.when(F.col("status") == status, F.col("id")))), ",").alias("ids"))


def id_pages(items: DataFrame, status: str, size: int = 1000) -> DataFrame:
    """klass, page (from 0) and the ids of a status on it, in order: no list is longer than ``size``, however large a class is."""
    placed = ordinals.within(items.where(F.col("status") == status).select("klass", "id"), ["klass"], "id", name="place")
    paged = placed.groupBy("klass", F.floor(F.col("place") / size).cast("long").alias("page"))
    ids = F.transform(F.array_sort(F.collect_list(F.struct("place", "id"))), lambda x: x["id"].cast("string"))
    return paged.agg(F.array_join(ids, ",").alias("ids"))
