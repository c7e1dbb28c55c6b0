"""Exact duplicates by content hash, and near duplicates by Hamming distance of 64-bit hashes."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import scalars


def groups(items: DataFrame, first: str, second: str) -> DataFrame:
    """A row a fingerprint, neither null nor empty, that several items have, with its kind: within one corpus, or across."""
    known = items.where(F.col("fingerprint").isNotNull() & (F.col("fingerprint") != ""))
    found = known.groupBy("fingerprint").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("corpus") == first).alias("n_first"),
        F.count_if(F.col("corpus") == second).alias("n_second"),
        F.countDistinct("klass").alias("n_classes"),
        F.min("id").alias("first_id"),
    )
    kind = F.when(F.col("n_second") == 0, F.lit(f"within-{first}")).when(F.col("n_first") == 0, F.lit(f"within-{second}")).otherwise("cross-dataset")
    return found.where("n > 1").withColumn("dup_type", kind)


def members(items: DataFrame, found: DataFrame) -> DataFrame:
    """The items of duplicate groups with their group's kind."""
    return items.join(found.select("fingerprint", "dup_type"), "fingerprint").select("fingerprint", "dup_type", "id", "klass", "corpus")


def summary(items: DataFrame, found: DataFrame) -> DataFrame:
    """One row: items, groups, extra copies and their share, groups by kind."""
    total = items.agg(F.count("*").alias("total"))
    counts = found.agg(
        F.count("*").alias("dup_groups"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_copies"),
        F.count_if(F.col("dup_type") == "cross-dataset").alias("cross_groups"),
        F.count_if(F.col("dup_type").startswith("within")).alias("within_groups"),
    )
    return total.join(F.broadcast(counts)).withColumn("dup_pct", F.round(scalars.percent(F.col("extra_copies"), F.col("total")), 4))


def extras_by_type(found: DataFrame) -> DataFrame:
    """Groups and extra copies by kind, with the extra copies inside each corpus, which cross groups hide."""
    inside = [F.sum(F.greatest(F.col(c) - 1, F.lit(0))).alias(n) for c, n in (("n_first", "extra_in_first"), ("n_second", "extra_in_second"))]
    return found.groupBy("dup_type").agg(F.count("*").alias("dup_groups"), F.sum(F.col("n") - 1).alias("extra_copies"), *inside)


def verdict(found: DataFrame, near: DataFrame) -> DataFrame:
    """Whether corpora are safe to combine: SAFE, CAUTION (exact copies across) or WARNING (near ones too)."""
    cross = found.agg(F.count_if(F.col("dup_type") == "cross-dataset").alias("cross_groups"))
    pairs = near.agg(F.count("*").alias("near_pairs"))
    exact, close = F.col("cross_groups"), F.col("near_pairs")
    word = F.when((exact == 0) & (close == 0), "SAFE").when(close == 0, "CAUTION").otherwise("WARNING")
    return cross.join(F.broadcast(pairs)).withColumn("verdict", word).withColumn("safe_to_combine", (exact == 0) & (close == 0))


def near_pairs(hashes: DataFrame, first: str, second: str, most: int) -> DataFrame:
    """Pairs across two corpora, of one class, whose hashes differ in at most ``most`` bits and whose content differs.

    Two items without a fingerprint count as equal content, as two unknown hashes cannot be told apart. The class is
    the join's key; AQE splits a class that holds most rows.
    """
    a = hashes.where((F.col("corpus") == first) & F.col("hash").isNotNull()).select(F.col("klass"), F.col("id").alias("first_id"), F.col("hash").alias("first_hash"), F.col("fingerprint").alias("first_print"))
    b = hashes.where((F.col("corpus") == second) & F.col("hash").isNotNull()).select(F.col("klass").alias("k"), F.col("id").alias("second_id"), F.col("hash").alias("second_hash"), F.col("fingerprint").alias("second_print"))
    distance = scalars.hamming(F.col("first_hash"), F.col("second_hash"))
    differ = ~F.col("first_print").eqNullSafe(F.col("second_print"))
    return a.join(b, (F.col("klass") == F.col("k")) & differ & (distance <= most)).select("klass", "first_id", "second_id", distance.cast("int").alias("distance"))


# --- near pairs by a multi-index ------------------------------------------------------------------------------------

WIDTH = 64
#: Costs in comparisons of the direct join, which takes two nanoseconds for one on eight cores: of a probe, of a candidate.
PROBE_COST, CANDIDATE_COST = 300.0, 20.0
MOST_PROBES = 4096


@dataclass(frozen=True)
class Band:
    """Bits from low, width of them, in which a pair is met if they differ in at most radius."""

    low: int
    width: int
    radius: int

    @property
    def masks(self) -> list[int]:
        """Every set of at most radius flipped bits."""
        return [sum(1 << i for i in bits) for k in range(self.radius + 1) for bits in combinations(range(self.width), k)]

    @property
    def n_masks(self) -> int:
        return sum(comb(self.width, k) for k in range(self.radius + 1))

    def of(self, x: Column) -> Column:
        return F.shiftrightunsigned(x, self.low).bitwiseAND(F.lit((1 << self.width) - 1 if self.width < WIDTH else -1).cast("long"))


def bands_of(most: int, n: int) -> list[Band]:
    """n bands that cover 64 bits. Of most = n * r + a differing bits, one of the first a + 1 bands has r at most, or one of the others r - 1."""
    cuts = [WIDTH * i // n for i in range(n + 1)]
    r, a = divmod(most, n)
    bands = [Band(cuts[i], cuts[i + 1] - cuts[i], r if i <= a else r - 1) for i in range(n)]
    return [b for b in bands if b.radius >= 0]


def chosen_bands(most: int, partners: float) -> list[Band]:
    """The bands that look cheapest for a hash with so many partners of its class on the other side; none where comparing it to all is cheaper."""

    def cost(bands: list[Band]) -> float:
        if not bands:
            return partners
        return PROBE_COST * sum(b.n_masks for b in bands) + CANDIDATE_COST * partners * sum(b.n_masks / 2.0**b.width for b in bands)

    plans = [bands_of(most, n) for n in range(1, min(32, most + 1) + 1)]
    return min(([], *(p for p in plans if sum(b.n_masks for b in p) <= MOST_PROBES)), key=cost)


#: A key has its band above its bits; one band of all bits needs no number.
BAND_SHIFT = 58


def met(first: DataFrame, second: DataFrame, bands: list[Band]) -> DataFrame:
    """Pairs of distinct (klass, hash) that meet in a band: the second side is posted under each band's bits, the first under
    all its neighbours. The key is (class, band and bits), so a class with most of the items is spread by its hashes."""
    if len(bands) > 1 and max(b.width for b in bands) > BAND_SHIFT or len(bands) >= 1 << (63 - BAND_SHIFT) or sum(b.n_masks for b in bands) > MOST_PROBES:
        raise ValueError("too many bands or neighbours, or too wide bands, for a key")

    def key(i: int, band: Band) -> Column:
        return band.of(F.col("hash")).bitwiseXOR(F.lit(i << BAND_SHIFT).cast("long"))

    def neighbours(i: int, band: Band) -> Column:
        masks = F.array(*(F.lit(m).cast("long") for m in band.masks))
        return F.transform(masks, lambda m: key(i, band).bitwiseXOR(m))

    posts = F.array(*(key(i, band) for i, band in enumerate(bands)))
    probes = F.concat(*(neighbours(i, band) for i, band in enumerate(bands)))
    a = first.select("klass", F.col("hash").alias("first_hash"), F.explode(probes).alias("key"))
    b = second.select("klass", F.col("hash").alias("second_hash"), F.explode(posts).alias("key"))
    # Spark judges exploded rows by their files and would broadcast them; posts are few beside probes, which need no sort.
    met_ = a.join(b.hint("shuffle_hash"), ["klass", "key"])
    return met_.withColumn("band", F.shiftright("key", BAND_SHIFT) if len(bands) > 1 else F.lit(0))


def near_pairs_indexed(hashes: DataFrame, first: str, second: str, most: int, bands: list[Band] | None = None) -> DataFrame:
    """The pairs of near_pairs() by multi-index hashing, for large classes: only hashes that are near in a band are compared.

    Distinct hashes of a class meet, not items; a pair counts in the first band in which it is near enough, so nothing
    need be made distinct; items are joined to the pairs at the end. Bands are chosen by the mean class of distinct
    hashes, unless they are given; where classes are so small that comparing all is cheaper, near_pairs() does that.
    """
    known = hashes.where(F.col("hash").isNotNull() & F.col("klass").isNotNull())
    sides = [known.where(F.col("corpus") == c).select("klass", "id", "hash", "fingerprint") for c in (first, second)]
    distinct = [s.select("klass", "hash").distinct() for s in sides]
    if bands is None:
        sizes = distinct[1].groupBy("klass").agg(F.count("*").alias("n")).agg((F.sum(F.col("n") * F.col("n")) / F.sum("n")).alias("partners")).first()
        bands = chosen_bands(most, sizes.partners or 0.0)
    if not bands:
        return near_pairs(hashes, first, second, most)
    differ = F.col("first_hash").bitwiseXOR(F.col("second_hash"))
    earlier = F.lit(False)
    for i, b in enumerate(bands[:-1]):
        earlier = earlier | ((F.lit(i) < F.col("band")) & (F.bit_count(b.of(differ)) <= b.radius))
    near = met(*distinct, bands).where((F.bit_count(differ) <= most) & ~earlier).select("klass", "first_hash", "second_hash", F.bit_count(differ).cast("int").alias("distance"))
    for name, side in zip(("first", "second"), sides, strict=True):
        items = side.select("klass", F.col("hash").alias(f"{name}_hash"), F.col("id").alias(f"{name}_id"), F.col("fingerprint").alias(f"{name}_print"))
        near = near.join(items, ["klass", f"{name}_hash"])
    return near.where(~F.col("first_print").eqNullSafe(F.col("second_print"))).select("klass", "first_id", "second_id", "distance")


def near_pairs_banded(hashes: DataFrame, first: str, second: str, most: int) -> DataFrame:
    """The same pairs by bands alone: of most + 1 bands, hashes that differ in at most ``most`` bits share one."""
    return near_pairs_indexed(hashes, first, second, most, bands_of(most, most + 1))
