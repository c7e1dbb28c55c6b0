"""Images, file corpora, sinks and streams."""

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quern.functions import draws, images
from quern.operators import augment, ordinals
from quern.plans import pictures, registry
from quern.sources import files, listing, sinks, tables
from quern.streaming import incremental


def picture(seed, h=24, w=20, c=3):
    return np.random.default_rng(seed).integers(0, 256, (h, w, c), dtype=np.uint8)


@pytest.mark.parametrize("channels", [1, 2, 3, 4])
def test_png_round_trip(channels):
    image = picture(1, c=channels)
    assert (images.decode_png(images.encode_png(image)) == image).all()


@pytest.mark.parametrize("kind", [1, 2, 3, 4])
def test_png_filters(kind):
    image, step = picture(2, 5, 7, 3).astype(int), 3
    flat = image.reshape(5, -1)
    for y in range(5):
        above = flat[y - 1] if y else np.zeros_like(flat[0])
        coded = np.zeros_like(flat[y])
        for i in range(len(coded)):
            left, corner = (flat[y][i - step], above[i - step]) if i >= step else (0, 0)
            p = left + above[i] - corner
            guess = {1: left, 2: above[i], 3: (left + above[i]) // 2, 4: min((left, above[i], corner), key=lambda v: abs(p - v))}[kind]
            coded[i] = (flat[y][i] - guess) & 255
        assert (images._unfiltered(kind, coded.astype(np.uint8), above.astype(np.uint8), step) == flat[y]).all()


@pytest.mark.parametrize("damage", [b"", b"no png", images.encode_png(picture(3))[:-9], images.encode_png(picture(3))[:60] + b"x" + images.encode_png(picture(3))[61:]])
def test_damaged_png_is_an_error(damage):
    with pytest.raises(ValueError):
        images.decode_png(damage)


def test_kernels_keep_size_and_identity():
    image = picture(4)
    for made in (images.rotated(image, 0), images.scaled(image, 1.0), images.noisy(image, 0.0, np.random.default_rng(1)), images.resized(image, 24, 20)):
        assert (made == image).all()
    for made in (images.rotated(image, 13.0), images.scaled(image, 0.9), images.scaled(image, 1.1), images.blurred(image)):
        assert made.shape == image.shape and made.dtype == np.uint8
    flat = np.full((9, 9, 3), 77, np.uint8)
    assert all((f == 77).all() for f in (images.rotated(flat, 9), images.scaled(flat, 1.07), images.blurred(flat)))
    square = picture(5, 8, 8)
    assert (images.rotated(square, 90)[1:, 1:] == np.rot90(square)[:-1, 1:]).mean() > 0.9 or images.rotated(square, 360).tolist() == square.tolist()
    assert (images.swapped(images.swapped(image)) == image).all() and (images.swapped(image)[..., 0] == image[..., 2]).all()


def test_augmentation_depends_on_the_seed_alone():
    image = picture(6)
    a, b = (images.augmented(image, 5, augment.ROTATION, augment.SCALING, augment.NOISE_SIGMA) for _ in range(2))
    assert (a == b).all()
    assert any((images.augmented(image, s, augment.ROTATION, augment.SCALING, augment.NOISE_SIGMA) != a).any() for s in (6, 7))


def test_perceptual_hash_survives_scaling():
    image = images.blurred(images.blurred(picture(7, 40, 40).repeat(4, 0).repeat(4, 1)))
    near = images.resized(image, 120, 120)
    distance = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count()
    assert distance(images.perceptual_bits(image), images.perceptual_bits(near)) <= 10
    assert distance(images.perceptual_bits(image), images.perceptual_bits(picture(8, 160, 160))) > 10


@pytest.fixture(scope="module")
def corpus(tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus one")
    for klass in ("ka", "a b"):
        (root / klass).mkdir()
        for i in range(3):
            (root / klass / f"{klass}_{i}.png").write_bytes(images.encode_png(picture(i)))
    (root / "ka" / "broken.PNG").write_bytes(b"nothing")
    (root / "ka" / "notes.txt").write_text("x")
    (root / "ka" / "deep").mkdir()
    (root / "ka" / "deep" / "d.png").write_bytes(b"x")
    (root / "top.png").write_bytes(b"x")
    return str(root)


def test_scan_and_inspection(spark, corpus):
    found = files.scan(spark, corpus, "A")
    assert found.count() == 8
    assert {r.klass for r in found.select("klass").collect()} == {"ka", "a b"}
    seen = files.inspected(files.supported(found)).collect()
    assert len(seen) == 7 and sorted(r.is_valid for r in seen) == [False] + [True] * 6
    good = [r for r in seen if r.is_valid]
    assert {(r.width, r.height, r["mode"]) for r in good} == {(20, 24, "RGB")}
    assert len({r.fingerprint for r in good}) == 3 and len({r.phash for r in good}) == 3
    assert files.scan_corpora(spark, {"A": corpus, "B": corpus}).orderBy("scan_order").first().corpus == "A"
    assert {r.klass: r.n for r in files.file_counts(spark, corpus, dotted_only=True).collect()}["ka"] == 5


def test_labelled_images(spark, corpus):
    every = files.labelled_images(files.scan(spark, corpus, "A")).collect()
    assert [r.pixels for r in every if r.error] == [None]  # told, not dropped
    rows = [r for r in every if not r.error]
    assert len(rows) == 6 and {(r.klass, r.class_index) for r in rows} == {("a b", 0), ("ka", 1)}
    assert all(len(r.pixels) == 64 * 64 * 3 and 0 <= min(r.pixels) and max(r.pixels) <= 1 for r in rows)


def test_generated_files(spark, corpus, tmp_path):
    sources = files.supported(files.scan(spark, corpus, "A")).where("file_name <> 'broken.PNG'").withColumn("id", F.xxhash64("path"))
    planned = augment.plan(sources.select("id", "klass"), 5, 42, ["id"])
    made = files.generated(planned, sources, augment.ROTATION, augment.SCALING, augment.NOISE_SIGMA)
    first = {r.generated_name: r.sha256_aug for r in made.collect()}
    assert len(first) == 4 and first == {r.generated_name: r.sha256_aug for r in made.repartition(3).collect()}
    statuses = [sinks.write_files(made, str(tmp_path), ["klass"], "generated_name").collect() for _ in range(2)]
    assert [{r.status for r in s} for s in statuses] == [{"written"}, {"kept"}]
    assert files.scan(spark, str(tmp_path), "G").count() == 4


def test_missing_sources(spark, tmp_path):
    with pytest.raises(tables.SourceNotFound):
        files.scan(spark, str(tmp_path / "none"), "A")
    assert tables.optional(spark, str(tmp_path / "none.csv"), "a int, b string").columns == ["a", "b"]


def test_csv_and_json_round_trips(spark, tmp_path):
    df = spark.createDataFrame([(1, 'x,"y"\nz'), (2, None)], "a int, b string")
    sinks.write_csv(df, str(tmp_path / "c"))
    assert sorted(tables.csv(spark, str(tmp_path / "c"), "a int, b string").collect()) == sorted(df.collect())
    assert not sinks.write_csv_if_any(df.limit(0), str(tmp_path / "none")) and sinks.write_csv_if_any(df, str(tmp_path / "some"))
    summary = df.agg(F.count("*").alias("n"), F.struct(F.max("a").alias("m")).alias("s"))
    sinks.write_summary(summary, str(tmp_path / "j"))
    assert tables.json(spark, str(tmp_path / "j"), summary.schema).first() == summary.first()
    assert json.loads(sinks.to_json(summary)) == {"n": 2, "s": {"m": 2}}
    sinks.write_partitioned(df, str(tmp_path / "p"), "a")
    assert spark.read.parquet(str(tmp_path / "p")).where("a = 1").count() == 1


def test_report_and_size_check(spark):
    df = spark.createDataFrame([("a", 1), ("b", 22)], "k string, n long")
    text = sinks.render("Title", {"Part": df}, most=1)
    assert "Title\n=====" in text and "a  1" in text and "and more" in text
    got = sinks.with_size_check(df, spark.createDataFrame([("a", 1), ("c", 1)], "k string, expected long"), "k").collect()
    assert {r.k: r.status for r in got} == {"a": "MATCH", "b": "MISMATCH", "c": "MISMATCH"}


def test_streaming_dedupe_and_counts(spark, sf_dir, tmp_path):
    batch = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    batch.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    for name, made in (("unique_users", incremental.first_seen(stream, "user_id", "ts", "10000 days")), ("per_hour", incremental.windowed_counts(stream, "event_type"))):
        query = made.writeStream.format("memory").queryName(name).outputMode("append" if name == "unique_users" else "append").option("checkpointLocation", str(tmp_path / name)).start()
        query.processAllAvailable()
        query.stop()
    assert spark.table("unique_users").count() == batch.select("user_id").distinct().count()
    closed = spark.table("per_hour").agg(F.sum("n")).first()[0]
    assert 0 < closed <= batch.count()


def test_discovery_and_split_counts(spark, tmp_path):
    for name, n in (("x/set/train/a", 2), ("x/set/train/b", 1), ("x/set/validation/a", 1), ("x/set/test/b", 3)):
        (tmp_path / name).mkdir(parents=True)
        for i in range(n):
            (tmp_path / name / f"{i}.png").write_bytes(b"x")
    found = files.discover(spark, str(tmp_path))
    assert found.endswith("x/set")
    assert {r.klass: tuple(r)[1:] for r in files.split_counts(spark, found).collect()} == {"a": (2, 1, 0), "b": (1, 0, 3)}
    with pytest.raises(tables.SourceNotFound):
        files.discover(spark, str(tmp_path / "x" / "set" / "train"))


def test_damage_is_an_error_row_and_never_an_exception(spark):
    good = images.encode_png(picture(3))
    short = images.PNG_SIGNATURE + images.encode_png(picture(3))[8:12] + b"IHDR"
    import struct
    import zlib

    header = b"IHDR" + b"\0" * 5
    wrong = images.PNG_SIGNATURE + struct.pack(">I", 5) + header + struct.pack(">I", zlib.crc32(header))
    for bad in (None, b"", short, wrong):
        with pytest.raises(ValueError):
            images.decode_png(bad)
    df = spark.createDataFrame([("a/1.png", "a", good), ("a/2.png", "a", None), ("a/3.png", "a", wrong)], "path string, klass string, content binary").withColumn("extension", F.lit(".png"))
    rows = {r.path: r.error for r in files.inspected(df).collect()}
    assert rows["a/1.png"] is None and all(rows[f"a/{i}.png"] for i in (2, 3))


def test_versions_keep_what_a_step_has_read(spark, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(tables.SourceNotFound):
        sinks.read_version(spark, root)
    assert sinks.versions(spark, root) == []
    sinks.write_version(spark.range(3), root)
    sinks.write_version(sinks.read_version(spark, root).where("id > 0"), root)
    (tmp_path / "t" / "v000003").mkdir()  # begun, never finished
    assert sinks.versions(spark, root) == [1, 2]
    assert [sinks.read_version(spark, root, n).count() for n in (1, 2, None)] == [3, 2, 2]
    with pytest.raises(tables.SourceNotFound):
        sinks.read_version(spark, root, 3)


@pytest.fixture(scope="module")
def greys(spark, sf_dir):
    return {r.id: pictures.grey(r.p) for r in pictures.greys(spark, sf_dir).collect()}


def test_noise_equals_the_kernel(spark, sf_dir, greys):
    for r in registry.queries()["image_noisy"](spark, sf_dir).collect():
        want = images.noisy(greys[r.id], 10.0, draws.Stream(42, r.id))
        assert r.pixels == ",".join(map(str, want.ravel()))


def test_demonstration_chains(spark, sf_dir, greys):
    noise = lambda seed: (lambda x: images.noisy(x, 10.0, draws.Stream(seed)))
    turn = lambda a: (lambda x: images.rotated(x, a))
    size = lambda f: (lambda x: images.scaled(x, f))
    plain = {
        "original": [],
        "step 1": [turn(12.0)],
        "step 2": [turn(12.0), size(1.08)],
        "step 3": [turn(12.0), size(1.08), noise(42)],
        "step 4": [turn(12.0), size(1.08), noise(42), images.blurred],
        "rotation": [turn(12.0)],
        "scaling": [size(1.08)],
        "noise": [noise(42)],
        "blur": [images.blurred],
        "rotation+noise": [turn(-8.0), noise(43)],
        "rotation+scaling+blur": [turn(10.0), size(0.93), images.blurred],
        "scaling+blur+noise": [size(1.05), images.blurred, noise(44)],
    }
    rows = registry.queries()["image_chains"](spark, sf_dir).collect()
    assert len(rows) == len(greys) * len(plain)
    for r in rows:
        image = greys[r.id]
        for step in plain[r.kind]:
            image = step(image)
        assert r.pixels == ",".join(map(str, image.ravel())), (r.id, r.kind)


def test_registered_parameters_equal_the_draws_of_a_seed(spark, sf_dir):
    rows = registry.queries()["augment_parameters"](spark, sf_dir).collect()
    assert rows and len({r.augmentation_type for r in rows}) == 8
    for r in rows:
        angle, has_scale, scale, noise, blur = draws.uniforms(r.random_seed, np.arange(5)).tolist()
        kinds = ["rotation", *(["scaling"] * (has_scale > 0.5)), *(["noise"] * (noise > 0.5)), *(["blur"] * (blur > 0.5))]
        factor = round(0.9 + (1.1 - 0.9) * scale, 6) if has_scale > 0.5 else 1.0
        assert (r.augmentation_type, r.rotation_angle, r.scale_factor, r.noise_sigma, r.blur_applied) == ("+".join(kinds), round(-15.0 + 30.0 * angle, 6), factor, 10.0 * (noise > 0.5), blur > 0.5)


def test_registered_files_are_made_from_their_source_and_seed(spark, sf_dir, greys):
    sources = pictures.as_files(pictures.greys(spark, sf_dir))
    planned = augment.plan(sources.select("id", "klass"), pictures.TARGET, 42, ["id"])
    rows = files.generated(planned, sources, augment.ROTATION, augment.SCALING, augment.NOISE_SIGMA).collect()
    assert rows
    for r in rows:
        if r.source_id % 17 == 0:
            assert r.content is None and r.sha256_aug is None
        else:
            want = images.augmented(greys[r.source_id], r.random_seed, augment.ROTATION, augment.SCALING, augment.NOISE_SIGMA)
            assert (images.decode_png(r.content) == want).all()


def test_formats_that_the_image_source_decodes(spark, tmp_path):
    jvm, folder = spark._jvm, tmp_path / "a +b%"
    folder.mkdir()
    image = picture(9, 4, 6)
    made = jvm.java.awt.image.BufferedImage(6, 4, 1)
    for y in range(4):
        for x in range(6):
            made.setRGB(x, y, int.from_bytes(image[y, x].tobytes(), "big"))
    for form in ("png", "jpg", "bmp", "tiff"):
        assert jvm.javax.imageio.ImageIO.write(made, form, jvm.java.io.File(str(folder / f"x.{form}")))
    palette = jvm.java.awt.image.BufferedImage(6, 4, 13)  # 256 colours
    for kind, form in (("palette", "png"), ("moving", "gif")):
        assert jvm.javax.imageio.ImageIO.write(palette, form, jvm.java.io.File(str(folder / f"{kind}.{form}")))
    (folder / "bad.jpg").write_bytes(b"bad")
    (folder / "bad.webp").write_bytes(b"RIFF")
    rows = {r.file_name: r for r in files.inspected_any(spark, str(tmp_path), "A").collect()}
    assert len(rows) == 8 and all(len(r.fingerprint) == 64 and r.klass == "a +b%" for r in rows.values())
    assert {n for n, r in rows.items() if not r.is_valid} == {"bad.jpg", "bad.webp"} == {n for n, r in rows.items() if r.error}
    assert {(r.width, r.height, r["mode"]) for r in rows.values() if r.is_valid} == {(6, 4, "RGB")}
    assert rows["x.png"].phash == rows["x.bmp"].phash == rows["x.tiff"].phash == images.perceptual_bits(image)
    assert rows["x.png"].fingerprint == files.inspected(files.scan(spark, str(tmp_path), "A").where("file_name = 'x.png'")).first().fingerprint
    pixels = {r.path.rsplit("/", 1)[1]: r.pixels for r in files.labelled_images(files.decoded(spark, str(tmp_path), "A"), 4).collect()}
    assert pixels["x.bmp"] == pixels["x.png"] == [float(np.float32(v / 255)) for v in images.resized(image, 4, 4).ravel()]
    assert pixels["bad.jpg"] is None and len(pixels["x.jpg"]) == 48


def test_every_regular_file_is_listed(spark, tmp_path):
    from quern.sources import listing

    for name, size in {"top.txt": 3, "a/x.png": 5, "a/empty": 0, "a/.hidden": 2, "a/_under.txt": 4, "_b/y": 1, ".c/z": 1, "a/deep/er/w +%é.gif": 6}.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x" * size)
    (tmp_path / "nothing here").mkdir()
    for parts in (1, 2, 64):
        rows = {r.path[len(str(tmp_path)) + 1 :]: (r.folder, r.file_name, r.extension, r["size"]) for r in listing.listed(spark, str(tmp_path), parts).collect()}
        assert rows == {
            "top.txt": (None, "top.txt", ".txt", 3),
            "a/x.png": ("a", "x.png", ".png", 5),
            "a/empty": ("a", "empty", "", 0),
            "a/.hidden": ("a", ".hidden", "", 2),
            "a/_under.txt": ("a", "_under.txt", ".txt", 4),
            "_b/y": ("_b", "y", "", 1),
            ".c/z": (".c", "z", "", 1),
            "a/deep/er/w +%é.gif": ("er", "w +%é.gif", ".gif", 6),
        }
    found = listing.listed(spark, f"file://{tmp_path}")
    (tmp_path / "a/x.png").unlink()
    read = {r.file_name: r for r in listing.with_content(spark.createDataFrame([(f"file://{tmp_path}/a/x.png", "x.png"), (f"file://{tmp_path}/a/empty", "empty"), (f"file://{tmp_path}/a/_under.txt", "_under.txt")], "path string, file_name string"), f"file://{tmp_path}").collect()}
    assert read["empty"].content == b"" and bytes(read["_under.txt"].content) == b"xxxx" and read["x.png"].content is None and read["x.png"].error
    assert found.count() == 7
    (tmp_path / "lone").mkdir()
    assert listing.listed(spark, str(tmp_path / "lone")).collect() == []


@pytest.fixture
def steps(spark, monkeypatch):
    """The functions given to mapInPandas, in order."""
    kind, given = type(spark.range(1)), []
    real = kind.mapInPandas
    monkeypatch.setattr(kind, "mapInPandas", lambda self, run, *more, **named: given.append(run) or real(self, run, *more, **named))
    return given


def test_image_rows_are_made_by_a_few_at_a_time(spark, steps):
    """What a task holds of made images does not grow with its batches, and no image is left out."""
    rows = spark.createDataFrame([(1, 1, [0] * 64)], "id long, label int, p array<int>")
    batch = pd.DataFrame({"id": range(1000), "label": 1, "p": [[i % 256] * 64 for i in range(1000)]})
    for make, each in ((lambda: pictures.through(rows, images.demonstrated), 12), (lambda: pictures.as_files(rows), 1)):
        steps.clear()
        make()
        made = list(steps[0](iter([batch, batch.iloc[:0], batch.iloc[:5]])))
        assert max(map(len, made)) <= images.FEW * each and sum(map(len, made)) == 1005 * each
        assert list(pd.concat(made)["id"].drop_duplicates()) == list(range(1000))


def test_file_rows_are_made_by_a_few_at_a_time(spark, tmp_path, steps):
    """Files are written, read, decoded and made by a few at a time, whatever the size of a batch."""
    content = images.encode_png(picture(3, 5, 5, 3))
    batch = pd.DataFrame({"path": [f"k/{i}.png" for i in range(300)], "klass": "k", "content": [b"" if i % 50 == 7 else content for i in range(300)], "random_seed": range(300), "source_id": range(300)})
    some = spark.createDataFrame([("k/0.png", "k", ".png", content)], "path string, klass string, extension string, content binary")
    planned = spark.createDataFrame([(1, 1, "k")], "source_id long, random_seed long, klass string")
    sources = spark.createDataFrame([(1, content)], "id long, content binary")
    batch["name"], batch["extension"] = batch["path"].str[2:], ".png"
    for make in (
        lambda: files.labelled_images(some, 4),
        lambda: files.inspected(some),
        lambda: files.generated(planned, sources, augment.ROTATION, augment.SCALING, augment.NOISE_SIGMA),
        lambda: sinks.write_files(some, f"file://{tmp_path}/out", ["klass"], "path"),
        lambda: listing.with_content(some.select("path"), f"file://{tmp_path}"),
    ):
        steps.clear()
        make()
        given = batch.assign(path=[f"file://{tmp_path}/none/{n}" for n in batch["name"]]) if make.__code__.co_names[0] == "listing" else batch
        given = given.assign(path=given["name"]) if "write_files" in make.__code__.co_names else given
        made = list(steps[0](iter([given])))
        assert max(map(len, made)) <= images.FEW and sum(map(len, made)) == 300, make.__code__.co_names
    assert sorted(p.name for p in (tmp_path / "out" / "k").iterdir()) == sorted(batch["name"])


def test_positions_start_no_python_worker(spark, sf_dir):
    placed = ordinals.ordered(spark.range(100).repartition(5), "id")
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and sorted(map(tuple, placed.collect())) == [(i, i) for i in range(100)]
