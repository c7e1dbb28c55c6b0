"""Reproducible stratified splits without leakage."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quern.functions import draws, scalars
from quern.operators import ordinals

SPLITS = ("train", "validation", "test")
#: Hex digits of a hash by which a class is ranked in parts: 4,096 of them.
PART_DIGITS = 3


def sizes(n: Column, val_ratio: float, test_ratio: float) -> tuple[Column, Column]:
    """How many of a class of n go to train and validation; the rest is the test split.

    Validation and test get their ratio, halves to even, one at least. Where nothing would be left to train on, it gets
    one, and validation and test share what then remains.
    """
    val, test = (F.greatest(F.lit(1), scalars.half_even(n * r)) for r in (val_ratio, test_ratio))
    train = n - val - test
    small = train < 1
    shared = F.when(val + test > n - 1, F.greatest(F.lit(1), F.expr("0") + ((n - 1) - F.pmod(n - 1, F.lit(2))) / 2)).otherwise(val).cast("long")
    return F.when(small, F.lit(1)).otherwise(train).cast("long"), F.when(small, shared).otherwise(val).cast("long")


def assign(items: DataFrame, seed: int, val_ratio: float = 0.1, test_ratio: float = 0.1) -> DataFrame:
    """items with split: a class is ordered by a hash of seed and id, and cut by sizes().

    The order does not depend on other classes or on partitions. A class is ranked in parts by the first digits of the
    hash, so a class with most of the items is not sorted in one task: ranks in a part, and how many rows of the class
    lie in the parts before it. That takes a second pass over classes and ids.
    """
    if min(val_ratio, test_ratio) < 0 or val_ratio + test_ratio >= 1:
        raise ValueError("ratios of validation and test must not be negative and must leave something to train on")
    key = F.sha2(F.concat(F.lit(f"{seed}|"), F.col("id").cast("string")), 256)
    part = F.substring(key, 1, PART_DIGITS)
    counts = items.groupBy(F.col("klass").alias("_klass"), part.alias("_part")).agg(F.count("*").alias("n"))
    by_class = Window.partitionBy("_klass")
    earlier = F.sum("n").over(by_class.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    starts = counts.select("_klass", "_part", earlier.alias("_earlier"), F.sum("n").over(by_class).alias("of"))
    within = F.row_number().over(Window.partitionBy("klass", part).orderBy(key, "id"))
    ranked = items.withColumn("_within", within)
    placed = ranked.join(starts, F.col("klass").eqNullSafe(F.col("_klass")) & (part == F.col("_part")))
    return _cut(placed.withColumn("place", F.col("_earlier") + F.col("_within")).drop("_klass", "_part", "_earlier", "_within"), val_ratio, test_ratio)


def _cut(ranked: DataFrame, val_ratio: float, test_ratio: float) -> DataFrame:
    train, val = sizes(F.col("of"), val_ratio, test_ratio)
    split = F.when(F.col("place") <= train, SPLITS[0]).when(F.col("place") <= train + val, SPLITS[1]).otherwise(SPLITS[2])
    return ranked.withColumn("split", split).drop("place", "of")


def assign_shuffled(items: DataFrame, seed: int, order: list[str], val_ratio: float = 0.1, test_ratio: float = 0.1) -> DataFrame:
    """The split of one generator that shuffles class after class, in order of names.

    A class's permutation depends on its size and on the classes before it. Only class sizes come to the driver;
    permutations go back as a table (class, position, place), as large as items, so this is for curated sets, not for
    raw corpora.
    """
    counts = sorted((r.klass, r.n) for r in items.groupBy("klass").agg(F.count("*").alias("n")).collect())
    rng, rows = random.Random(seed), []
    for klass, n in counts:
        shuffled = list(range(n))
        rng.shuffle(shuffled)
        rows += [(klass, position, place + 1, n) for place, position in enumerate(shuffled)]
    table = items.sparkSession.createDataFrame(rows, "klass string, position long, place long, of long")
    at = items.withColumn("position", (F.row_number().over(Window.partitionBy("klass").orderBy(*order)) - 1).cast("long"))
    return _cut(at.join(table, ["klass", "position"]).drop("position"), val_ratio, test_ratio)


#: Rounds of a keyed permutation.
ROUNDS = 4


def half_bits(n: np.ndarray) -> np.ndarray:
    """Half the bits of the least range 0..4**h-1 that holds n positions, h from 1 on."""
    return np.searchsorted(4 ** np.arange(1, 32, dtype=np.uint64), n.astype(np.uint64)) + 1


def permuted_array(position: np.ndarray, n: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """The places of positions of 0..n-1, each with a size and a seed of its own."""
    place, rest = position.astype(np.uint64), np.arange(len(position))
    n, half = n.astype(np.uint64), half_bits(n).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    while len(rest):  # a walk comes back to its beginning, which lies in the range
        x, h, m, s = place[rest], half[rest], mask[rest], seed[rest]
        high, low = x >> h, x & m
        for i in range(1, ROUNDS + 1):
            high, low = low, high ^ (draws.word_arrays(s, low, i)[0] & m)
        place[rest] = (high << h) | low
        rest = rest[place[rest] >= n[rest]]
    return place.astype(np.int64)


#: Rows whose places are worked out at once, so that arrays stay in a processor's cache.
PERMUTED_ROWS = 8192


def permuted(position: Column, n: Column, seed: Column) -> Column:
    """The place of a position in a pseudo-random permutation of 0..n-1, from position, n and seed alone; null outside of it.

    A Feistel network permutes the next range of a power of four; a value beyond n goes through it again until it lies
    below n, which makes a permutation of 0..n-1. Nothing is sorted, listed or collected. Rounds are worked out by numpy
    over batches: as nested column expressions they are not compiled, and took some 0.6 ms a row.
    """

    @F.arrow_udf("long")
    def places(position: pa.Array, n: pa.Array, seed: pa.Array) -> pa.Array:
        known = [pc.fill_null(c, missing).to_numpy(zero_copy_only=False) for c, missing in ((position, -1), (n, 0), (seed, 0))]
        inside = (known[0] >= 0) & (known[0] < known[1]) & seed.is_valid().to_numpy(zero_copy_only=False)
        out, rows = np.zeros(len(inside), np.int64), np.flatnonzero(inside)
        for at in range(0, len(rows), PERMUTED_ROWS):
            some = rows[at : at + PERMUTED_ROWS]
            out[some] = permuted_array(*(c[some] for c in known))
        return pa.array(out, mask=~inside)

    return places(position.cast("long"), n.cast("long"), seed.cast("long"))


def assign_permuted(items: DataFrame, seed: int, order: list[str], val_ratio: float = 0.1, test_ratio: float = 0.1) -> DataFrame:
    """A split by a keyed permutation of each class: a row's place follows from its position in the class's order.

    Unlike assign_shuffled() the driver holds nothing, and a class's permutation depends on its size and name alone.
    Places are worked out where rows were stored in order, so a class with most of the items is spread over tasks.
    """
    known = ordinals.within(items, ["klass"], *order, name="position", size="of")
    key = F.lit(seed).cast("long").bitwiseXOR(F.coalesce(scalars.class_offset(F.col("klass")), F.lit(0).cast("long")))
    return _cut(known.withColumn("place", permuted(F.col("position"), F.col("of"), key) + 1).drop("position"), val_ratio, test_ratio)


def assign_families(items: DataFrame, family: str, seed: int, val_ratio: float = 0.1, test_ratio: float = 0.1) -> DataFrame:
    """A split that keeps families together: the least id of a family is split, its other members follow."""
    heads = items.groupBy(family).agg(F.min_by(F.struct("klass", "id"), F.col("id")).alias("h"))
    placed = assign(heads.select(family, "h.klass", "h.id"), seed, val_ratio, test_ratio)
    return items.join(placed.select(family, "split"), family)


def statistics(split: DataFrame) -> DataFrame:
    """Items by class and split, with totals."""
    return split.groupBy("klass").agg(*(F.count_if(F.col("split") == s).alias(f"{s}_count") for s in SPLITS), F.count("*").alias("total_count"))


def shares(split: DataFrame) -> DataFrame:
    """Items by split and their share of all in percent."""
    counts = split.groupBy("split").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total)).select("split", "n", F.round(scalars.percent(F.col("n"), F.col("total")), 4).alias("share_pct"))


def rollup(split: DataFrame) -> DataFrame:
    """Class and split counts with subtotals and the grand total, marked TOTAL."""
    rolled = split.rollup("klass", "split").agg(F.count("*").alias("n"), F.grouping("klass").alias("gk"), F.grouping("split").alias("gs"))
    return rolled.select(F.when(F.col("gk") == 1, "TOTAL").otherwise(F.col("klass")).alias("klass"), F.when(F.col("gs") == 1, "TOTAL").otherwise(F.col("split")).alias("split"), "n")


def leaked(split: DataFrame) -> DataFrame:
    """Fingerprints that lie in more than one split."""
    found = split.where(F.col("fingerprint").isNotNull()).groupBy("fingerprint").agg(F.array_join(F.array_sort(F.collect_set("split")), ",").alias("splits"), F.countDistinct("split").alias("n_splits"), F.count("*").alias("n"))
    return found.where("n_splits > 1")


def leakage_counts(split: DataFrame) -> DataFrame:
    """For each pair of splits, how many fingerprints both have."""
    by = leaked(split).agg(*(F.count_if(F.col("splits").contains(a) & F.col("splits").contains(b)).alias(f"{a}_{b}") for a, b in ((SPLITS[0], SPLITS[1]), (SPLITS[0], SPLITS[2]), (SPLITS[1], SPLITS[2]))))
    return by.withColumn("leakage_found", F.expr(" + ".join(f"{a}_{b}" for a, b in ((SPLITS[0], SPLITS[1]), (SPLITS[0], SPLITS[2]), (SPLITS[1], SPLITS[2])))) > 0)


def leaked_rows(rows: DataFrame, held: DataFrame) -> DataFrame:
    """The rows whose fingerprint lies in held-out data."""
    return rows.join(held.select("fingerprint").distinct(), "fingerprint", "left_semi")


#: Bits of a filter for each key, most bits (4 MB on the driver and in each executor), and how many of them a key sets.
FILTER_BITS_EACH, FILTER_MOST_BITS, FILTER_HASHES = 12, 1 << 25, 5


def filter_bits(n: int) -> int:
    """A power of two with enough bits for n keys, as far as the bound goes."""
    return min(FILTER_MOST_BITS, max(64, 1 << (FILTER_BITS_EACH * n - 1).bit_length() if n else 64))


def _places(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(FILTER_HASHES)]


def key_filter(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """One row: the words of a Bloom filter over a column, made by a partial aggregate; what is broadcast has the filter's size."""
    marks = keys.where(F.col(key).isNotNull()).select(F.explode(F.array(*_places(F.col(key), bits))).alias("bit"))
    words = marks.groupBy(F.shiftright("bit", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, CAST(bit % 64 AS int)))").alias("word"))
    every = keys.sparkSession.range(bits // 64).withColumnRenamed("id", "at").join(words, "at", "left").select("at", F.coalesce("word", F.lit(0).cast("long")).alias("word"))
    return every.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]).alias("words"))  # bits / 64 numbers


def may_hold(words: Column, key: Column, bits: int) -> Column:
    """The key may be one of the filter's; false means that it is none, or null."""
    hits = [F.call_function("shiftright", F.get(words, F.shiftright(p, 6).cast("int")), (p % 64).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1 for p in _places(key, bits)]
    found = hits[0]
    for h in hits[1:]:
        found = found & h
    return key.isNotNull() & found


def filtered_rows(rows: DataFrame, held: DataFrame, key: str = "fingerprint", bits: int | None = None) -> DataFrame:
    """The rows whose key may lie in held-out data, told by a filter where they are scanned; nothing of rows is shuffled."""
    keys = held.select(key).where(F.col(key).isNotNull()).distinct()
    bits = bits or filter_bits(keys.count())
    words = ordinals.free(rows, "filter_words")
    one = F.broadcast(key_filter(keys, key, bits).withColumnRenamed("words", words))
    return rows.join(one).where(may_hold(F.col(words), F.col(key), bits)).drop(words)


def leaked_rows_filtered(rows: DataFrame, held: DataFrame, bits: int | None = None) -> DataFrame:
    """leaked_rows() for training data far larger than held-out data: only what passes a filter is shuffled for the exact join."""
    keys = held.select("fingerprint").distinct()
    return filtered_rows(rows, held, bits=bits).join(keys.hint("merge"), "fingerprint", "left_semi")


def require_no_leakage(split: DataFrame) -> DataFrame:
    """split itself; raises if a fingerprint lies in two splits."""
    if bad := leaked(split).limit(3).collect():
        raise ValueError(f"leakage between splits: {[(r.fingerprint, r.splits) for r in bad]}")
    return split
