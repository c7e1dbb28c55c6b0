"""The master manifest: one canonical item for each content, with provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions import scalars


def with_cached_hash(items: DataFrame, cache: DataFrame) -> DataFrame:
    """items with the fingerprint of a cache by id, or the content's own hash where the cache has none."""
    known = cache.select("id", F.col("fingerprint").alias("cached"))
    return items.drop("fingerprint").join(known, "id", "left").withColumn("fingerprint", F.coalesce("cached", scalars.content_hash(F.col("content")))).withColumn("from_cache", F.col("cached").isNotNull()).drop("cached")


def manifest(items: DataFrame, order: list[str]) -> DataFrame:
    """items with is_duplicate, canonical_id and include_in_master.

    The first item in scan order of a fingerprint is canonical, valid or not; items without one are their own. Only
    valid canonical items are included, so an invalid canonical item leaves out its copies too. A duplicate is taken
    as valid, as it is never decoded. ``order`` must tell items apart.

    The first of a fingerprint is a minimum that is pre-aggregated before the shuffle, and is joined back only to
    fingerprints that several items have; the join can be split where one fingerprint has most of the items.
    """
    place = F.struct(*order, F.col("id").alias("first_id"))
    first = items.where(F.col("fingerprint").isNotNull()).groupBy("fingerprint").agg(F.min(place).alias("first"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    ranked = items.join(first, "fingerprint", "left").withColumn("first_id", F.col("first.first_id"))
    duplicate = F.coalesce(F.col("first") < place, F.lit(False))
    return ranked.select(
        *[c for c in items.columns if c not in ("is_valid", "content")],
        (duplicate | F.col("is_valid")).alias("is_valid"),
        duplicate.alias("is_duplicate"),
        F.when(duplicate, F.col("first_id")).alias("canonical_id"),
        (~duplicate & F.col("is_valid")).alias("include_in_master"),
    )


def class_counts(entries: DataFrame, first: str, second: str) -> DataFrame:
    """Included items by class and corpus."""
    return (
        entries.where("include_in_master")
        .groupBy("klass")
        .agg(*(F.count_if(F.col("corpus") == c).alias(n) for c, n in ((first, "first_count"), (second, "second_count"))), F.count("*").alias("combined"))
    )


def summary(entries: DataFrame) -> DataFrame:
    """One row: included items and classes, their spread, and what was left out and why."""
    counts = entries.where("include_in_master").groupBy("klass").agg(F.count("*").alias("n"))
    spread = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_master"),
        F.count("*").alias("classes"),
        F.min("n").alias("min_per_class"),
        F.max("n").alias("max_per_class"),
        F.round(F.avg("n"), 6).alias("mean_per_class"),
        F.round(F.coalesce(F.stddev_samp("n"), F.lit(0.0)), 6).alias("std_per_class"),
    )
    left_out = entries.agg(F.count("*").alias("total_seen"), F.count_if("is_duplicate").alias("duplicates"), F.count_if(~F.col("is_valid")).alias("invalid"))
    return spread.join(F.broadcast(left_out))


def label_conflicts(items: DataFrame) -> DataFrame:
    """Fingerprints that items of several classes have."""
    found = items.where(F.col("fingerprint").isNotNull()).groupBy("fingerprint").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("klass")), ",").alias("classes"), F.countDistinct("klass").alias("n_classes"))
    return found.where("n_classes > 1")
