"""Positions, dense ranks, zips, quantiles, pages and keyed permutations, against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.functions import draws
from quern.operators import evaluation, inspection, ordinals, split


def rows(spark, n=500, hot=0.4):
    rng = random.Random(n)
    made = [(i, None if rng.random() < 0.05 else 7 if rng.random() < hot else rng.randrange(50), rng.choice(["a", "b", None])) for i in range(n)]
    return spark.createDataFrame(made, "id long, v int, klass string").repartition(6, "id"), made


def low(x):
    return (x is not None, x or 0)


def test_positions_cover_the_order(spark):
    df, made = rows(spark)
    got = ordinals.ordered(df, "v", F.col("id").desc()).collect()
    assert sorted((r.ordinal, r.id) for r in got) == list(enumerate(i for i, *_ in sorted(made, key=lambda r: (low(r[1]), -r[0]))))


def test_a_value_that_most_rows_share_is_split(spark):
    df = spark.range(4000).select("id", F.lit(1).alias("v")).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = ordinals.ordered(df, "v")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r.ordinal for r in placed.collect()) == list(range(4000))
    assert len(placed.inputFiles()) > 2


def test_positions_within_keys_and_dense_ranks(spark):
    df, made = rows(spark)
    want = {}
    for k in (None, "a", "b"):
        want |= {i: n for n, (i, *_) in enumerate(sorted((r for r in made if r[2] == k), key=lambda r: (low(r[1]), r[0])))}
    assert {r.id: r.ordinal for r in ordinals.within(df, ["klass"], "v", "id").collect()} == want
    values = sorted({r[1] for r in made}, key=low)
    assert all(values[r.dense_rank] == r.v for r in ordinals.dense(df, "v").collect())


def test_zip_of_unequal_frames_clashes_and_no_rows(spark):
    left, right = spark.range(5).select(F.col("id").alias("a")), spark.range(3).select(F.col("id").alias("b"))
    assert [(r.a, r.b) for r in ordinals.zipped(left, right, ["a"], [F.col("b").desc()]).orderBy("ordinal").collect()] == [(0, 2), (1, 1), (2, 0), (3, None), (4, None)]
    clash = spark.range(4).select("id", *(F.lit(9).alias(c) for c in ("scan_place", "part_place", "number", "before", "first_place", "key_0", "value_0")))
    assert sorted(r.ordinal for r in ordinals.within(clash, ["number"], "id").collect()) == [0, 1, 2, 3]
    assert ordinals.dense(clash, "before").first().dense_rank == 0
    for empty in (ordinals.ordered(clash.limit(0), "id"), ordinals.within(clash.limit(0), ["number"], "id"), ordinals.dense(clash.limit(0), "id")):
        assert empty.collect() == []


def test_quantiles(spark):
    df, made = rows(spark)
    at = [0.0, 0.1, 0.5, 0.77, 1.0]
    got = {(r.klass, r.quantile): r.value for r in evaluation.quantiles(df, "v", at, "klass").collect()}
    for k in (None, "a", "b"):
        v = sorted(r[1] for r in made if r[2] == k and r[1] is not None)
        for q in at:
            h = q * (len(v) - 1)
            assert got[k, q] == pytest.approx(v[int(h)] + (v[min(int(h) + 1, len(v) - 1)] - v[int(h)]) * (h - int(h)))
    assert evaluation.quantiles(df.limit(0), "v", [0.5]).collect() == []
    assert evaluation.confidence_stats(df.limit(0).withColumn("confidence", F.lit(1.0))).first().median is None
    with pytest.raises(ValueError):
        evaluation.quantiles(df, "v", [1.5])


def test_pages_of_ids_are_bounded(spark):
    items = spark.range(2500).select("id", F.lit("x").alias("klass"), F.when(F.col("id") % 5 == 0, "corrupt").otherwise("valid").alias("status"))
    got = {r.page: [int(i) for i in r.ids.split(",")] for r in inspection.id_pages(items, "corrupt", 200).collect()}
    assert got == {p: list(range(1000 * p, min(1000 * (p + 1), 2500), 5)) for p in range(3)}


@pytest.mark.parametrize("seed", [0, 42])
def test_permutations_are_whole_for_every_size(spark, seed):
    sizes = [*range(1, 70), 127, 128, 129, 255, 256, 257, 1000, 1024, 1025, 4097, 10_000]
    df = spark.createDataFrame([(n,) for n in sizes], "n long").repartition(8).select("n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("x"))
    got = df.withColumn("y", split.permuted(F.col("x"), F.col("n"), F.lit(seed).cast("long"))).groupBy("n").agg(F.countDistinct("y").alias("d"), F.min("y").alias("least"), F.max("y").alias("most"), F.count_if(F.col("x") == F.col("y")).alias("fixed")).collect()
    assert {r.n for r in got} == set(sizes)
    for r in got:
        assert (r.d, r.least, r.most) == (r.n, 0, r.n - 1)
        assert r.n < 100 or r.fixed < 12


def test_permuted_split_has_the_sizes_of_the_others(spark):
    items = spark.range(700).select("id", F.when(F.col("id") < 400, "a").when(F.col("id") < 698, "b").otherwise(None).alias("klass"))
    first, again = (split.assign_permuted(items, s, ["id"]) for s in (42, 43))
    count = lambda df: sorted(map(tuple, df.groupBy("klass", "split").count().collect()), key=str)
    assert count(first) == count(again) == count(split.assign(items, 42))
    assert {r.id: r.split for r in first.collect()} == {r.id: r.split for r in split.assign_permuted(items.repartition(7), 42, ["id"]).collect()} != {r.id: r.split for r in again.collect()}


@pytest.mark.parametrize("few", [0, 10_000])
def test_rows_of_a_hot_key_stay_dealt(spark, monkeypatch, few):
    """The look-up of a key's first row and the permutation do not bring the key's rows into one task."""
    monkeypatch.setattr(ordinals, "FEW_KEYS", few, raising=False)
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.files.openCostInBytes": "128m"}
    before = {k: spark.conf.get(k) for k in settings}
    items = spark.range(4000).select("id", F.when(F.col("id") % 100 == 0, F.col("id").cast("string")).otherwise("hot").alias("klass")).repartition(8)
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        placed = ordinals.within(items, ["klass"], "id").withColumn("task", F.spark_partition_id()).collect()
        cut = split.assign_permuted(items, 42, ["id"]).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert [(r.id, r.ordinal) for r in sorted(placed, key=lambda r: r.id) if r.klass == "hot"] == [(i, i - i // 100 - 1) for i in range(4000) if i % 100]
    assert all(r.ordinal == 0 for r in placed if r.klass != "hot")
    for rows_ in (placed, cut):
        tasks = [r.task for r in rows_]
        assert len(tasks) == 4000 and max(map(tasks.count, set(tasks))) < 2000


def test_permutation_equals_its_network_and_is_null_outside_of_its_range(spark):
    def plain(x, n, seed):
        half = next(h for h in range(1, 40) if 4**h >= n)
        while True:
            high, low = x >> half, x & ((1 << half) - 1)
            for i in range(1, split.ROUNDS + 1):
                high, low = low, high ^ (int(draws.word_arrays(seed, np.array([low]), i)[0][0]) & ((1 << half) - 1))
            x = high << half | low
            if x < n:
                return x

    made = [(x, n, s) for n in (1, 2, 4, 5, 17, 4**20, 4**20 + 1, 3 * 10**12) for s in (0, 42, -9, (1 << 62) + 3) for x in {0, n // 3, n - 1}]
    odd = [(None, 5, 1), (1, None, 1), (1, 5, None), (5, 5, 1), (-1, 5, 1), (0, 0, 1)]
    df = spark.createDataFrame(made + odd, "x long, n long, s long").coalesce(1)
    for r in df.withColumn("y", split.permuted(F.col("x"), F.col("n"), F.col("s"))).collect():
        assert r.y == (None if (r.x, r.n, r.s) in odd else plain(r.x, r.n, r.s)), r
