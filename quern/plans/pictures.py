"""Queries over images: the kernels, and image files written, scanned, inspected and read back."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import draws, images
from quern.operators import augment
from quern.plans.registry import register
from quern.sources import files, listing, sinks
from quern.sources.tables import table

SIDE = 8
ANGLE, LARGER, SMALLER, ENLARGED = 12.0, 1.08, 0.93, 12

# An embedding as a grey image of 8 by 8, row by row; pixel(row, column) is its value there.
GREY_SQL = "greys AS (SELECT vec_id AS id, label, list_transform(embedding, lambda x: greatest(0, least(255, floor(128 + 256 * x::DOUBLE)))::INTEGER) AS p FROM embeddings)"


def greys(spark: SparkSession, d: str) -> DataFrame:
    """embeddings as grey images: id, label and 64 pixels."""
    pixels = F.transform("embedding", lambda x: F.greatest(F.lit(0), F.least(F.lit(255), F.floor(F.lit(128) + F.lit(256) * x.cast("double")))).cast("int"))
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "label", pixels.alias("p"))


def grey(pixels) -> np.ndarray:
    return np.asarray(pixels, np.uint8).reshape(SIDE, SIDE, 1)


def shown(image: np.ndarray) -> str:
    return ",".join(map(str, image.ravel().tolist()))


def through(rows: DataFrame, made: Callable[[np.ndarray], dict[str, np.ndarray]]) -> DataFrame:
    """A row for each image that is made of each grey image: id, its name, height, width and values row by row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in images.few(batches):
            out = [(i, name, *image.shape[:2], shown(image)) for i, p in zip(batch["id"], batch["p"], strict=True) for name, image in made(grey(p)).items()]
            yield pd.DataFrame(out, columns=["id", "kind", "height", "width", "pixels"])

    return rows.select("id", "p").mapInPandas(run, "id long, kind string, height int, width int, pixels string")


def folded(at: str, n: int) -> str:
    """SQL of an index reflected into 0..n-1."""
    q = 2 * (n - 1)
    return f"(CASE WHEN (({at}) % {q} + {q}) % {q} >= {n} THEN {q} - (({at}) % {q} + {q}) % {q} ELSE (({at}) % {q} + {q}) % {q} END)"


def sampled_sql(kind: str, side: int, y: str, x: str, source: str = "greys") -> str:
    """SQL of an image of side by side whose pixel (r, c) is taken at the fractional place (y, x)."""
    value = "p[({0}) * 8 + ({1}) + 1]".format
    row0, row1, col0, col1 = folded("y0", SIDE), folded("y0 + 1", SIDE), folded("x0", SIDE), folded("x0 + 1", SIDE)
    return f"""SELECT id, '{kind}' AS kind, {side} AS height, {side} AS width, string_agg(v::VARCHAR, ',' ORDER BY r, c) AS pixels FROM (
      SELECT id, r, c, greatest(0, least(255, round_even(({value('r0', 'c0')} * (1 - fx) + {value('r0', 'c1')} * fx) * (1 - fy) + ({value('r1', 'c0')} * (1 - fx) + {value('r1', 'c1')} * fx) * fy, 0)))::INTEGER AS v
      FROM {source}, (SELECT r, c, y - y0 AS fy, x - x0 AS fx, {row0} AS r0, {row1} AS r1, {col0} AS c0, {col1} AS c1
        FROM (SELECT *, floor(y)::INTEGER AS y0, floor(x)::INTEGER AS x0 FROM (SELECT r, c, {y} AS y, {x} AS x FROM range({side}) a(r), range({side}) b(c)))))
      GROUP BY id"""


def enlarged_sql(at: str, side: int) -> str:
    """SQL of the place in 8 pixels that pixel ``at`` of ``side`` pixels is taken from."""
    return f"greatest(0, least({SIDE - 1}, ({at} + '0.5'::DOUBLE) * {SIDE} / {side} - '0.5'::DOUBLE))"


def scaled_sql(factor: float, source: str = "greys") -> str:
    new = round(SIDE * factor)
    shift = (new - SIDE) // 2 if new >= SIDE else -((SIDE - new) // 2)
    return sampled_sql("scaled", SIDE, *(enlarged_sql(folded(f"{a} + {shift}", new), new) for a in ("r", "c")), source)


def rotated_sql(degrees: float, source: str = "greys") -> str:
    sin, cos = (f"'{f(math.radians(degrees))!r}'::DOUBLE" for f in (math.sin, math.cos))
    return sampled_sql("rotated", SIDE, f"(c - 4) * {sin} + (r - 4) * {cos} + 4", f"(c - 4) * {cos} - (r - 4) * {sin} + 4", source)


@register("image_rotated", f"WITH {GREY_SQL} " + rotated_sql(ANGLE))
def image_rotated(spark: SparkSession, d: str) -> DataFrame:
    return through(greys(spark, d), lambda image: {"rotated": images.rotated(image, ANGLE)})


@register("image_scaled_up", f"WITH {GREY_SQL} " + scaled_sql(LARGER))
def image_scaled_up(spark: SparkSession, d: str) -> DataFrame:
    return through(greys(spark, d), lambda image: {"scaled": images.scaled(image, LARGER)})


@register("image_scaled_down", f"WITH {GREY_SQL} " + scaled_sql(SMALLER))
def image_scaled_down(spark: SparkSession, d: str) -> DataFrame:
    return through(greys(spark, d), lambda image: {"scaled": images.scaled(image, SMALLER)})


@register("image_resized", f"WITH {GREY_SQL} " + sampled_sql("resized", ENLARGED, enlarged_sql("r", ENLARGED), enlarged_sql("c", ENLARGED)))
def image_resized(spark: SparkSession, d: str) -> DataFrame:
    return through(greys(spark, d), lambda image: {"resized": images.resized(image, ENLARGED, ENLARGED)})


BLUR_SUM = " + ".join(f"{wy * wx} * p[{folded(f'r + {dy}', SIDE)} * 8 + {folded(f'c + {dx}', SIDE)} + 1]" for dy, wy in ((-1, 1), (0, 2), (1, 1)) for dx, wx in ((-1, 1), (0, 2), (1, 1)))


@register(
    "image_blurred",
    f"""WITH {GREY_SQL} SELECT id, 'blurred' AS kind, 8 AS height, 8 AS width, string_agg(v::VARCHAR, ',' ORDER BY r, c) AS pixels
    FROM (SELECT id, r, c, ({BLUR_SUM} + 8) // 16 AS v FROM greys, range(8) a(r), range(8) b(c)) GROUP BY id""",
)
def image_blurred(spark: SparkSession, d: str) -> DataFrame:
    return through(greys(spark, d), lambda image: {"blurred": images.blurred(image)})


@register(
    "image_swapped",
    f"""WITH {GREY_SQL} SELECT id, 'swapped' AS kind, 8 AS height, 8 AS width, string_agg((x // 2)::VARCHAR || ',' || (255 - x)::VARCHAR || ',' || x::VARCHAR, ',' ORDER BY i) AS pixels
    FROM (SELECT id, unnest(p) AS x, generate_subscripts(p, 1) AS i FROM greys) GROUP BY id""",
)
def image_swapped(spark: SparkSession, d: str) -> DataFrame:
    """Blue and red exchanged in images of a pixel, what it lacks to 255, and half of it."""
    return through(greys(spark, d), lambda image: {"swapped": images.swapped(np.concatenate([image, 255 - image, image // 2], axis=2))})


def noise_sql(source: str, sigma: float, seed: int, stream: str = "0") -> str:
    """SQL: id and p of a table with normal noise on its pixels."""
    pixels = f"(SELECT id, unnest(p) AS x, generate_subscripts(p, 1) - 1 AS i FROM {source})"
    drawn = f"(SELECT id, i, x, {draws.uniform_sql()} AS u FROM ({draws.words_sql(pixels, str(seed), 'i', stream)}))"
    value = f"floor(greatest(0.0::FLOAT, least(255.0::FLOAT, x::FLOAT + ((z * '{sigma!r}'::DOUBLE)::FLOAT))))::INTEGER"
    return f"SELECT id, list({value} ORDER BY i) AS p FROM (SELECT id, i, x, {draws.inverse_normal_sql('u')} AS z FROM {drawn}) GROUP BY id"


@register("image_noisy", f"WITH {GREY_SQL} SELECT id, 'noisy' AS kind, 8 AS height, 8 AS width, array_to_string(p, ',') AS pixels FROM ({noise_sql('greys', augment.NOISE_SIGMA, 42, 'id')})")
def image_noisy(spark: SparkSession, d: str) -> DataFrame:
    """Normal noise, of its own for each image, by column expressions."""
    made = greys(spark, d).withColumn("p", draws.noisy(F.col("p"), augment.NOISE_SIGMA, 42, F.col("id")))
    return made.select("id", F.lit("noisy").alias("kind"), F.lit(SIDE).alias("height"), F.lit(SIDE).alias("width"), F.array_join(F.transform("p", lambda x: x.cast("string")), ",").alias("pixels"))


def step_sql(source: str, kind: str, value) -> str:
    """SQL: id and p of a table after a step of a chain."""
    if kind == "noisy":
        return noise_sql(source, *value)
    if kind == "blurred":
        return f"SELECT id, list(v ORDER BY r, c) AS p FROM (SELECT id, r, c, ({BLUR_SUM} + 8) // 16 AS v FROM {source}, range(8) a(r), range(8) b(c)) GROUP BY id"
    made = scaled_sql(value, source) if kind == "scaled" else rotated_sql(value, source)
    return f"SELECT id, list_transform(string_split(pixels, ','), lambda x: x::INTEGER) AS p FROM ({made})"


def chains_sql() -> str:
    """SQL of every demonstration chain, a common table expression for each distinct beginning."""
    known, tables = {(): "greys"}, []

    def named(steps: tuple) -> str:
        if steps not in known:
            before = named(steps[:-1])
            known[steps] = f"chain_{len(known)}"
            tables.append(f"{known[steps]} AS MATERIALIZED ({step_sql(before, *steps[-1])})")
        return known[steps]

    parts = [("original", ())] + [(f"step {i}", images.SEQUENCE[:i]) for i in range(1, len(images.SEQUENCE) + 1)] + list(images.CHAINS.items())
    rows = [f"SELECT id, '{name}' AS kind, 8 AS height, 8 AS width, array_to_string(p, ',') AS pixels FROM {named(tuple(steps))}" for name, steps in parts]
    return f"WITH {', '.join([GREY_SQL, *tables])} " + " UNION ALL ".join(rows)


@register("image_chains", chains_sql())
def image_chains(spark: SparkSession, d: str) -> DataFrame:
    """The demonstration chains."""
    return through(greys(spark, d), images.demonstrated)


# --- image files ----------------------------------------------------------------------------------------------------


def as_files(rows: DataFrame) -> DataFrame:
    """The images as files: class, file name and content; one in 17 is damaged, one in 11 is no image by its name."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in images.few(batches):
            content = [b"damaged" if i % 17 == 0 else images.encode_png(grey(p)) for i, p in zip(batch["id"], batch["p"], strict=True)]
            yield pd.DataFrame({"id": batch["id"], "label": batch["label"], "content": content})

    made = rows.mapInPandas(run, "id long, label int, content binary")
    name = F.concat(F.col("id").cast("string"), F.when(F.col("id") % 11 == 0, ".txt").when(F.col("id") % 5 == 0, ".PNG").otherwise(".png"))
    return made.select("id", F.concat(F.lit("class "), F.col("label").cast("string")).alias("klass"), name.alias("file_name"), "content")


NAMED_SQL = "named AS (SELECT *, 'class ' || label AS klass, id || CASE WHEN id % 11 = 0 THEN '.txt' WHEN id % 5 = 0 THEN '.PNG' ELSE '.png' END AS file_name FROM greys)"


def written(spark: SparkSession, d: str, *folders: str) -> str:
    """The root of the image files, one folder a class, below the folders of other columns."""
    root = sinks.scratch(spark, "images")
    rows = as_files(greys(spark, d)).withColumn("corpus", F.when(F.col("id") % 2 == 0, "A").otherwise("B")).withColumn("place", F.lit("a set")).withColumn("split", F.when(F.col("id") % 3 == 0, "test").otherwise("train"))
    status = sinks.write_files(rows, root, [*folders, "klass"], "file_name").groupBy(F.substring("status", 1, 7).alias("status")).agg(F.count("*").alias("n"))
    if bad := [r for r in status.collect() if r.status == "failed:"]:  # a row a status
        raise OSError(f"{bad[0].n} files were not written below {root}")
    return root


@register("files_written", f"WITH {GREY_SQL}, {NAMED_SQL} SELECT klass, file_name, 'written' AS status FROM named")
def files_written(spark: SparkSession, d: str) -> DataFrame:
    status = sinks.write_files(as_files(greys(spark, d)), sinks.scratch(spark, "images"), ["klass"], "file_name")
    parts = F.split("path", "/")
    return status.select(F.element_at(parts, -2).alias("klass"), F.element_at(parts, -1).alias("file_name"), "status")


@register("files_scanned", f"WITH {GREY_SQL}, {NAMED_SQL} SELECT klass, file_name, lower(right(file_name, 4)) AS extension, CASE WHEN id % 2 = 0 THEN 'A' ELSE 'B' END AS corpus, (id % 2)::INTEGER AS corpus_rank FROM named")
def files_scanned(spark: SparkSession, d: str) -> DataFrame:
    """Two corpora of class folders in order of precedence."""
    root = written(spark, d, "corpus")
    found = files.scan_corpora(spark, {c: f"{root}/{c}" for c in ("A", "B")})
    return found.select("klass", "file_name", "extension", "corpus", F.col("scan_order.corpus_rank").alias("corpus_rank"))


@register("files_supported", f"WITH {GREY_SQL}, {NAMED_SQL} SELECT klass, count(*) AS n FROM named WHERE lower(file_name) LIKE '%.png' GROUP BY 1")
def files_supported(spark: SparkSession, d: str) -> DataFrame:
    return files.supported(files.scan(spark, written(spark, d), "A")).groupBy("klass").agg(F.count("*").alias("n"))


@register("files_counted", f"WITH {GREY_SQL}, {NAMED_SQL} SELECT klass, count(*) AS n FROM named GROUP BY 1")
def files_counted(spark: SparkSession, d: str) -> DataFrame:
    """Files with a dot in their name by folder, below two corpora."""
    return files.file_counts(spark, written(spark, d, "corpus"), dotted_only=True)


@register("files_by_split", f"WITH {GREY_SQL}, {NAMED_SQL} SELECT klass, count_if(id % 3 <> 0)::BIGINT AS train_count, 0::BIGINT AS validation_count, count_if(id % 3 = 0)::BIGINT AS test_count FROM named GROUP BY 1")
def files_by_split(spark: SparkSession, d: str) -> DataFrame:
    """A folder that has the splits is found; a split without a folder counts 0."""
    found = files.discover(spark, written(spark, d, "place", "split"), ("train", "test"))
    return files.split_counts(spark, found)


@register(
    "files_inspected",
    f"""WITH {GREY_SQL}, {NAMED_SQL} SELECT klass, file_name, CASE WHEN id % 17 <> 0 THEN 8 END AS width, CASE WHEN id % 17 <> 0 THEN 8 END AS height, CASE WHEN id % 17 <> 0 THEN 'L' END AS mode,
    CASE WHEN id % 17 = 0 THEN 'not a PNG' END AS error, id % 17 <> 0 AS is_valid FROM named WHERE id % 11 <> 0""",
)
def files_inspected(spark: SparkSession, d: str) -> DataFrame:
    found = files.inspected(files.supported(files.scan(spark, written(spark, d), "A")))
    return found.select("klass", "file_name", "width", "height", "mode", "error", "is_valid")


@register(
    "files_labelled",
    f"""WITH {GREY_SQL}, {NAMED_SQL} SELECT file_name, klass, (SELECT count(DISTINCT o.klass) FROM named o WHERE o.klass < n.klass)::INTEGER AS class_index,
    CASE WHEN id % 17 <> 0 THEN array_to_string(list_transform(p, lambda x: x || ',' || x || ',' || x), ',') END AS pixels, id % 17 = 0 AS failed FROM named n WHERE id % 11 <> 0""",
)
def files_labelled(spark: SparkSession, d: str) -> DataFrame:
    """Images as a network takes them, with the index of their class; the shares of 255 are shown as whole numbers."""
    found = files.labelled_images(files.scan(spark, written(spark, d), "A"), SIDE)
    whole = F.array_join(F.transform("pixels", lambda x: F.round(x * 255).cast("int").cast("string")), ",")
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "klass", "class_index", whole.alias("pixels"), F.col("error").isNotNull().alias("failed"))


ODD_SQL = f"""{NAMED_SQL}, odd AS (SELECT id, klass, CASE WHEN id % 7 = 0 THEN '_' WHEN id % 5 = 0 THEN '.' ELSE '' END || file_name AS file_name, id % 13 = 0 AS is_empty FROM named)"""


@register("files_listed", f"WITH {GREY_SQL}, {ODD_SQL} SELECT klass AS folder, file_name, lower(right(file_name, 4)) AS extension, is_empty FROM odd")
def files_listed(spark: SparkSession, d: str) -> DataFrame:
    """Every regular file below a root, whose names begin with underscores and dots too, and some of which are empty."""
    root = sinks.scratch(spark, "listed")
    prefix = F.when(F.col("id") % 7 == 0, "_").when(F.col("id") % 5 == 0, ".").otherwise("")
    odd = as_files(greys(spark, d)).withColumns({"file_name": F.concat(prefix, "file_name"), "content": F.when(F.col("id") % 13 == 0, F.lit(b"")).otherwise(F.col("content"))})
    status = sinks.write_files(odd, root, ["klass"], "file_name").where("status <> 'written'")
    if bad := status.limit(3).collect():
        raise OSError(f"files were not written below {root}: {bad}")
    return listing.listed(spark, root).select("folder", "file_name", "extension", (F.col("size") == 0).alias("is_empty"))


TARGET = 70


@register(
    "files_generated",
    f"""WITH {GREY_SQL}, {NAMED_SQL}, ranked AS (SELECT *, row_number() OVER (PARTITION BY klass ORDER BY id) - 1 AS r, count(*) OVER (PARTITION BY klass) AS n FROM named),
    wanted AS (SELECT klass, n, unnest(range(greatest({TARGET} - n, 0))) AS aug_index FROM (SELECT DISTINCT klass, n FROM ranked))
    SELECT w.klass, w.aug_index, ranked.id AS source_id, 'aug_' || w.klass || '_' || lpad(w.aug_index::VARCHAR, 6, '0') || '.png' AS generated_name, ranked.id % 17 <> 0 AS made
    FROM wanted w JOIN ranked ON ranked.klass = w.klass AND ranked.r = w.aug_index % w.n""",
)
def files_generated(spark: SparkSession, d: str) -> DataFrame:
    """PNGs made from sources and seeds; a damaged source makes none. Their pixels are tested by brute force."""
    sources = as_files(greys(spark, d))
    planned = augment.plan(sources.select("id", "klass"), TARGET, 42, ["id"])
    made = files.generated(planned, sources, augment.ROTATION, augment.SCALING, augment.NOISE_SIGMA)
    return made.select("klass", "aug_index", "source_id", "generated_name", F.col("content").isNotNull().alias("made"))
