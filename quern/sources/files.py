"""Corpora of files: one folder a class, decoded and validated where they are images."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import images, scalars
from quern.sources.tables import SourceNotFound, exists, require

# Extensions by stage; each stage takes its own set.
IMAGES = (".jpg", ".jpeg", ".png", ".bmp", ".tiff", ".tif", ".webp")
IMAGES_INSPECTED = (*IMAGES, ".gif")

INSPECTED = "width int, height int, mode string, error string, phash long, dhash long"


def _placed(spark: SparkSession, found: DataFrame, root: str) -> DataFrame:
    """Rows whose path is <root>/<class>/<file>, with class, file_name and extension."""
    base = spark._jvm.org.apache.hadoop.fs.Path(root)
    full = base.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(base).toString().rstrip("/")
    parts = F.split(F.substring(F.regexp_replace("path", "^file:/+", "file:/"), len(full.replace("file:///", "file:/")) + 2, 1 << 30), "/")
    rows = found.withColumn("parts", parts).where((F.size("parts") == 2) & ~F.col("parts")[0].startswith("."))
    name = F.col("parts")[1]
    return rows.withColumns({"file_name": name, "klass": F.col("parts")[0], "extension": scalars.suffix(name)}).drop("parts")


def scan(spark: SparkSession, root: str, corpus: str) -> DataFrame:
    """Files at <root>/<class>/<file>: path, file_name, class, extension, size, corpus and content.

    Deeper and shallower files are left out, and folders that begin with a dot. Spark's file listing also leaves out
    files without a byte, and files and folders that begin with a dot or an underscore. Content is only read by plans
    that use it.
    """
    require(spark, root)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    rows = _placed(spark, found, root)
    return rows.select("path", "file_name", "klass", "extension", F.col("length").alias("size"), F.lit(corpus).alias("corpus"), "content")


def decoded(spark: SparkSession, root: str, corpus: str) -> DataFrame:
    """scan() with the pixels of an image in place of its content, as Spark's image source decodes them: PNG of any depth, palette or interlacing, JPEG, BMP, GIF, TIFF.

    Columns as scan()'s but size and content, and decoded: height, width, channels and data, which is null where the
    file is no such image. inspected() and labelled_images() take these rows as they take those of scan(); the
    fingerprint is that of the file.
    """
    require(spark, root)
    found = spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", True).load(root)
    image = F.struct("image.height", "image.width", F.col("image.nChannels").alias("channels"), "image.data")
    origin = F.url_decode(F.regexp_replace("image.origin", r"\+", "%2B"))  # the address, where scan() has the path
    rows = _placed(spark, found.select(F.regexp_replace(origin, "^file:/+", "file:/").alias("path"), F.when(F.col("image.height") >= 0, image).alias("decoded")), root)
    return rows.select("path", "file_name", "klass", "extension", F.lit(corpus).alias("corpus"), "decoded")


def _image(value) -> np.ndarray:
    """The image of a file's content, or of what the image source made of it; ValueError where there is none."""
    if not isinstance(value, dict):
        return images.decode_png(value)
    shape = (value["height"], value["width"], value["channels"])
    order = {1: [0], 3: [2, 1, 0], 4: [2, 1, 0, 3]}[shape[2]]  # blue comes first in the source
    return np.frombuffer(bytes(value["data"]), np.uint8).reshape(shape)[..., order]


def _pixels(files: DataFrame) -> str:
    """The column that images are made from."""
    return "decoded" if "decoded" in files.columns else "content"


def scan_corpora(spark: SparkSession, roots: dict[str, str]) -> DataFrame:
    """Several corpora in order of precedence; scan_order puts the earlier corpus, class and file first."""
    out = None
    for rank, (corpus, root) in enumerate(roots.items()):
        one = scan(spark, root, corpus).withColumn("scan_order", F.struct(F.lit(rank).alias("corpus_rank"), "klass", "file_name"))
        out = one if out is None else out.unionByName(one)
    return out


def supported(files: DataFrame, extensions: tuple[str, ...] = IMAGES) -> DataFrame:
    return files.where(F.col("extension").isin(*extensions))


def inspected(files: DataFrame) -> DataFrame:
    """Rows of scan() or decoded() with fingerprint, extent, mode, perceptual hashes, and is_valid or the error of those that cannot be decoded.

    Only PNGs of 8 bits are decoded from content. Fingerprints of decoded() are read in a scan of their own and joined
    by path, after the pixels are gone.
    """
    source = _pixels(files)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in images.few(batches):
            rows = []
            for value in batch[source]:
                try:
                    image = _image(value)
                    rows.append((image.shape[1], image.shape[0], images.MODES[image.shape[2]], None, images.perceptual_bits(image), images.gradient_bits(image)))
                except ValueError as e:
                    rows.append((None, None, None, str(e), None, None))
            found = pd.DataFrame(rows, columns=[x.split()[0] for x in INSPECTED.split(", ")], index=batch.index).astype({c: "Int64" for c in ("width", "height", "phash", "dhash")})
            yield pd.concat([batch.drop(columns=source), found], axis=1)

    base = files.withColumn("fingerprint", scalars.content_hash(F.col("content"))) if source == "content" else files
    kept = [c for c in base.columns if c not in (source, "scan_order")]
    ddl = ", ".join(f"`{c}` {base.schema[c].dataType.simpleString()}" for c in kept)
    return base.select(*kept, source).mapInPandas(run, f"{ddl}, {INSPECTED}").withColumn("is_valid", F.col("error").isNull())


def inspected_any(spark: SparkSession, root: str, corpus: str, extensions: tuple[str, ...] = IMAGES_INSPECTED) -> DataFrame:
    """inspected() of images in every format that decoded() covers, with the fingerprints of their files."""
    prints = scan(spark, root, corpus).select("path", scalars.content_hash(F.col("content")).alias("fingerprint"))
    prints = prints.withColumn("path", F.regexp_replace("path", "^file:/+", "file:/"))
    return inspected(supported(decoded(spark, root, corpus), extensions)).join(prints, "path")


def discover(spark: SparkSession, root: str, names: tuple[str, ...] = ("train", "validation", "test")) -> str:
    """The first folder, widest level first and by name, that has subfolders of all the names; only folders are listed."""
    require(spark, root)
    start = spark._jvm.org.apache.hadoop.fs.Path(root)
    store = start.getFileSystem(spark._jsc.hadoopConfiguration())
    level = [start]
    while level:
        below = []
        for folder in level:
            inside = sorted((s.getPath() for s in store.listStatus(folder) if s.isDirectory()), key=lambda p: p.getName())
            if set(names) <= {p.getName() for p in inside}:
                return folder.toString()
            below += inside
        level = below
    raise SourceNotFound(f"no folder below {root} has {', '.join(names)}")


def split_counts(spark: SparkSession, root: str, names: tuple[str, ...] = ("train", "validation", "test")) -> DataFrame:
    """Files by class in each split's folder, 0 where a class or a split has none."""
    out = None
    for name in names:
        here = f"{root}/{name}"
        one = file_counts(spark, here) if exists(spark, here) else spark.createDataFrame([], "klass string, n long")
        one = one.withColumn("split", F.lit(name))
        out = one if out is None else out.unionByName(one)
    wide = out.groupBy("klass").pivot("split", list(names)).agg(F.sum("n"))
    return wide.na.fill(0).select("klass", *(F.col(n).alias(f"{n}_count") for n in names))


def file_counts(spark: SparkSession, root: str, dotted_only: bool = False) -> DataFrame:
    """Files below a folder, all or those with a dot in their name, by the folder they lie in. Reads no content."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    rows = found.where(scalars.basename(F.col("path")).contains(".")) if dotted_only else found
    return rows.groupBy(scalars.parent_name(F.col("path")).alias("klass")).agg(F.count("*").alias("n"))


def labelled_images(files: DataFrame, side: int = 64, extensions: tuple[str, ...] = IMAGES) -> DataFrame:
    """path, class, class_index, pixels (side by side by 3, as shares of 255) and error, of scan() or decoded(); images that cannot be decoded have null pixels."""
    from quern.operators.evaluation import class_index

    source = _pixels(files)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in images.few(batches):
            rows = []
            for path, klass, content in zip(batch["path"], batch["klass"], batch[source], strict=True):
                try:
                    image = _image(content)
                except ValueError as e:
                    rows.append((path, klass, None, str(e)))
                    continue
                colour = image[..., :3] if image.shape[2] >= 3 else image[..., :1].repeat(3, axis=2)
                rows.append((path, klass, (images.resized(colour, side, side) / 255.0).ravel().astype("float32"), None))
            yield pd.DataFrame(rows, columns=["path", "klass", "pixels", "error"])

    rows = supported(files, extensions).select("path", "klass", source).mapInPandas(run, "path string, klass string, pixels array<float>, error string")
    return rows.join(F.broadcast(class_index(files, "klass")), "klass")  # as many rows as classes


def generated(planned: DataFrame, sources: DataFrame, rotation: tuple[float, float], scaling: tuple[float, float], sigma: float) -> DataFrame:
    """planned rows with the PNG content made from their source and seed, and its hash; content is null where the source cannot be decoded."""
    joined = planned.join(sources.select(F.col("id").alias("source_id"), "content"), "source_id")
    kept = [c for c in joined.columns if c != "content"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in images.few(batches):
            made = []
            for content, seed in zip(batch["content"], batch["random_seed"], strict=True):
                try:
                    made.append(images.encode_png(images.augmented(images.decode_png(content), int(seed), rotation, scaling, sigma)))
                except ValueError:
                    made.append(None)
            yield batch[kept].assign(content=made)

    ddl = ", ".join(f"`{c}` {joined.schema[c].dataType.simpleString()}" for c in kept) + ", content binary"
    return joined.select(*kept, "content").mapInPandas(run, ddl).withColumn("sha256_aug", scalars.content_hash(F.col("content")))
