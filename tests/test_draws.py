"""Counter-based draws: published answers, the three forms against each other, and their distribution."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.functions import draws, images
from quern.operators import augment

#: Published answers: counter, stream, key and both words.
KNOWN = [
    (0, 0, 0, (0x6B200159, 0x99BA4EFE)),
    (0xFFFFFFFF, 0xFFFFFFFF, 0xFFFFFFFFFFFFFFFF, (0x1CB996FC, 0xBB002BE7)),
    (0x243F6A88, 0x85A308D3, 0x03707344_13198A2E, (0xC4923A9C, 0x483DF7A0)),
]


@pytest.mark.parametrize(("counter", "stream", "key", "want"), KNOWN)
def test_known_answers(spark, counter, stream, key, want):
    a, b = draws.word_arrays(key, np.array([counter]), stream)
    assert (int(a[0]), int(b[0])) == want
    signed = key - (1 << 64) if key >> 63 else key
    got = spark.range(1).select(draws.words(F.lit(signed), counter, stream).alias("w")).first().w
    assert (got.a, got.b) == want
    sql = draws.words_sql("(SELECT 1 AS one)", str(signed), str(counter), str(stream))
    assert duckdb.sql(f"SELECT a, b FROM ({sql})").fetchall()[0] == want


def test_columns_numpy_and_sql_agree(spark):
    seeds = [0, 1, 42, 1769416267, (1 << 40) + 5, -7]
    rows = spark.createDataFrame([(s, i) for s in seeds for i in range(50)], "seed long, i long")
    got = rows.select("seed", "i", draws.uniform(F.col("seed"), F.col("i"), 3).alias("u")).collect()
    table = " UNION ALL ".join(f"SELECT {s}::BIGINT AS seed, unnest(range(50)) AS i" for s in seeds)
    sql = {(s, i): u for s, i, u in duckdb.sql(f"SELECT seed, i, {draws.uniform_sql()} FROM ({draws.words_sql(f'({table})', 'seed', 'i', '3')})").fetchall()}
    for r in got:
        assert r.u == draws.uniforms(r.seed, np.array([r.i]), 3)[0] == sql[r.seed, r.i]
    assert len({r.u for r in got}) == len(got)


def test_normals_agree_with_the_distribution(spark):
    z = spark.range(40).select(F.explode(draws.normals(F.col("id"), 500)).alias("z")).toPandas().z.to_numpy()
    want = np.concatenate([draws.Stream(s).normal(0.0, 1.0, (500,)) for s in range(40)])
    np.testing.assert_allclose(np.sort(z), np.sort(want), rtol=1e-12)
    assert abs(z.mean()) < 0.03 and abs(z.std() - 1) < 0.03
    for p in (1e-15, 1e-4, 0.02, 0.024249, 0.02425, 0.3, 0.5, 0.7, 0.97575, 0.98, 1 - 1e-9):
        x = float(draws.inverse_normals(np.array([p]))[0])
        assert 0.5 * math.erfc(-x / math.sqrt(2)) == pytest.approx(p, rel=2e-8)
        assert spark.range(1).select(draws.inverse_normal(F.lit(p))).first()[0] == pytest.approx(x, rel=1e-14)
        assert duckdb.sql(f"SELECT {draws.inverse_normal_sql(f'{p!r}::DOUBLE')}").fetchall()[0][0] == pytest.approx(x, rel=1e-14)


def test_uniform_numbers_fill_the_interval():
    u = draws.uniforms(9, np.arange(100_000))
    assert 0 < u.min() and u.max() < 1
    assert np.abs(np.histogram(u, 20, (0, 1))[0] - 5000).max() < 300
    assert abs(np.corrcoef(u[:-1], u[1:])[0, 1]) < 0.01


def test_noise_of_empty_and_null_pixels(spark):
    rows = spark.createDataFrame([([],), (None,), ([0, 255, 128],)], "p array<int>")
    got = [r.p for r in rows.select(draws.noisy(F.col("p"), 10.0, 1).alias("p")).collect()]
    want = images.noisy(np.array([0, 255, 128], np.uint8).reshape(1, 3, 1), 10.0, draws.Stream(1)).ravel().tolist()
    assert got == [[], None, want]


def test_parameters_stay_in_the_jvm_and_match_what_is_made(spark):
    planned = spark.range(200).select(F.lit("k").alias("klass"), (F.col("id") * 7919).alias("random_seed"))
    made = augment.with_parameters(planned)
    assert "Python" not in made._jdf.queryExecution().executedPlan().toString()
    image = np.arange(64, dtype=np.uint8).reshape(8, 8, 1) * 3
    for r in made.limit(40).collect():
        want = images.rotated(image, -15.0 + 30.0 * float(draws.uniforms(r.random_seed, np.array([0]))[0]))
        if "scaling" in r.augmentation_type:
            want = images.scaled(want, 0.9 + (1.1 - 0.9) * float(draws.uniforms(r.random_seed, np.array([2]))[0]))
        if r.noise_sigma:
            want = images.noisy(want, r.noise_sigma, draws.Stream(r.random_seed, 1))
        want = images.blurred(want) if r.blur_applied else want
        assert (images.augmented(image, r.random_seed, augment.ROTATION, augment.SCALING, augment.NOISE_SIGMA) == want).all()
    assert images.augmented(image, 5, augment.ROTATION, augment.SCALING, augment.NOISE_SIGMA, sequential=True).shape == image.shape
