"""Augmentation plans: which rows to generate so that every class reaches a size, with their seeds and names."""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quern.functions import draws, scalars

# The ranges that parameters are drawn from, and the noise.
ROTATION = (-15.0, 15.0)
SCALING = (0.9, 1.1)
NOISE_SIGMA = 10.0


def need(train: DataFrame, target: int) -> DataFrame:
    """How many rows each class lacks; classes that have enough need none."""
    counts = train.groupBy("klass").agg(F.count("*").alias("n_orig"))
    return counts.withColumn("n_needed", F.greatest(F.lit(target) - F.col("n_orig"), F.lit(0)))


def plan(train: DataFrame, target: int, seed: int, order: list[str]) -> DataFrame:
    """A row for each row to generate: its index, the source it takes in turn, its seed and its name.

    Sources are ranked within their class and joined by (class, rank), so nothing is collected; a class without rows
    gets none. Only classes that lack rows are ranked: they have fewer than ``target``, which bounds what a task sorts.
    """
    wanted = need(train, target).where("n_needed > 0")
    short = train.join(wanted.select("klass"), "klass", "left_semi")
    ranked = short.withColumn("rank", (F.row_number().over(Window.partitionBy("klass").orderBy(*order)) - 1).cast("long")).select("klass", F.col("id").alias("source_id"), "rank")
    rows = wanted.select("klass", "n_orig", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_needed") - 1)).alias("aug_index"))
    picked = rows.withColumn("rank", F.pmod(F.col("aug_index"), F.col("n_orig"))).join(ranked, ["klass", "rank"])
    return picked.select(
        "klass",
        "aug_index",
        "source_id",
        scalars.row_seed(seed, scalars.class_offset(F.col("klass")), F.col("aug_index")).alias("random_seed"),
        F.concat(F.lit("aug_"), F.col("klass"), F.lit("_"), F.lpad(F.col("aug_index").cast("string"), 6, "0"), F.lit(".png")).alias("generated_name"),
    )


#: Counters of a seed's draws; noise has a stream of its own.
ANGLE, HAS_SCALE, SCALE, HAS_NOISE, HAS_BLUR = range(5)
NOISE_STREAM = 1


def with_parameters(planned: DataFrame) -> DataFrame:
    """planned with the parameters that each seed stands for: kind, angle, scale, noise, blur. Column expressions only."""

    def draw(counter: int):
        return draws.uniform(F.col("random_seed"), counter)

    scaled, noise, blur = (draw(i) > 0.5 for i in (HAS_SCALE, HAS_NOISE, HAS_BLUR))
    made = planned.withColumns({"_scaled": scaled, "_noise": noise, "_blur": blur})
    kinds = F.concat(F.lit("rotation"), *(F.when(F.col(f"_{k}"), "+" + name).otherwise("") for k, name in (("scaled", "scaling"), ("noise", "noise"), ("blur", "blur"))))
    return made.select(
        *planned.columns,
        kinds.alias("augmentation_type"),
        F.round(draws.between(*ROTATION, draw(ANGLE)), 6).alias("rotation_angle"),
        F.when(F.col("_scaled"), F.round(draws.between(*SCALING, draw(SCALE)), 6)).otherwise(1.0).alias("scale_factor"),
        F.when(F.col("_noise"), NOISE_SIGMA).otherwise(0.0).alias("noise_sigma"),
        F.col("_blur").alias("blur_applied"),
    )


def drawn(seed: int) -> tuple[str, float, float, float, bool]:
    """The parameters of a seed by Python's own generator: a draw is only made where it is used."""
    rng = random.Random(seed)
    kinds, angle, scale = ["rotation"], rng.uniform(*ROTATION), 1.0
    if rng.random() > 0.5:
        kinds.append("scaling")
        scale = rng.uniform(*SCALING)
    noise, blur = (rng.random() > 0.5 for _ in range(2))
    kinds += ["noise"] * noise + ["blur"] * blur
    return "+".join(kinds), round(angle, 6), round(scale, 6), NOISE_SIGMA if noise else 0.0, blur


def with_sequential_parameters(planned: DataFrame) -> DataFrame:
    """with_parameters() of Python's own generator, in Arrow batches."""
    ddl = "augmentation_type string, rotation_angle double, scale_factor double, noise_sigma double, blur_applied boolean"

    @F.pandas_udf(ddl)
    def of(seeds: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([drawn(int(s)) for s in seeds], columns=[x.split()[0] for x in ddl.split(", ")])

    return planned.withColumn("p", of("random_seed")).select(*planned.columns, "p.*")


def counts(train: DataFrame, planned: DataFrame, target: int) -> DataFrame:
    """Original, generated and final rows by class with a TOTAL row, whether each class reaches the target, and by how much it falls short."""
    both = train.select("klass", F.lit(1).alias("o"), F.lit(0).alias("g")).unionAll(planned.select("klass", F.lit(0), F.lit(1)))
    rolled = both.rollup("klass").agg(F.sum("o").alias("original_count"), F.sum("g").alias("generated_count"), F.countDistinct("klass").alias("n"), F.grouping("klass").alias("is_total"))
    final = F.col("original_count") + F.col("generated_count")
    return rolled.select(
        F.when(F.col("is_total") == 1, "TOTAL").otherwise(F.col("klass")).alias("klass"),
        "original_count",
        "generated_count",
        final.alias("final_count"),
        (F.col("n") * target - final).alias("shortfall"),
        F.when(final == F.col("n") * target, "PASS").otherwise("FAIL").alias("status"),
    )


def combined(train: DataFrame, planned: DataFrame) -> DataFrame:
    """Originals and generated rows as one table."""
    originals = train.select("klass", F.col("id").cast("string").alias("name"), F.col("id").alias("source_id"), F.lit(None).cast("long").alias("random_seed"))
    return originals.unionByName(planned.select("klass", F.col("generated_name").alias("name"), "source_id", "random_seed"))
