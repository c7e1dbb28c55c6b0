import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import whitening
from quern.llm.whitening import Moments, Params, symmetric_qr

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, most=16):
    """By the plain formulas: all vectors in memory, LAPACK's eigenvectors."""
    good = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v, *_ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dim = max((len(v) for _, v in good), default=0)
    good = [(i, tuple(v + [1_000_000] * (dim - len(v)))) for i, v in good]
    fit = sorted({v for _, v in good})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    if n < 2:
        return {}
    gaps = np.array([[n * x - s for x, s in zip(v, sums, strict=True)] for v in fit], float) / n
    values, vectors = np.linalg.eigh(gaps.T @ gaps / n)
    values, vectors = values[::-1], vectors[:, ::-1].T
    count = min(most, int((values > 1e-12 * values[0]).sum()))
    out = {}
    for i, v in good:
        gap = [n * x - s for x, s in zip(v, sums, strict=True)]
        for k in range(count):
            out.setdefault((i, k + 1), []).append((n, sum(g * g for g in gap), float(np.array(gap, float) / n @ vectors[k] / math.sqrt(values[k])), float(values[k] / values.sum())))
    return out


def check(df, rows, params=Params()):
    want, got = brute(rows), {}
    for r in whitening.whiten(df, params).collect():
        got.setdefault((r.vec_id, r.component), []).append((r.n, r.deviation, r.whitened, r.explained))
        assert r.identity_error <= 1e-9
    assert got.keys() == want.keys()
    sign = {}
    for (i, k), many in want.items():
        many, mine = sorted(many, key=lambda m: (m[1], abs(m[2]))), sorted(got[i, k], key=lambda m: (m[1], abs(m[2])))
        for a, b in zip(many, mine, strict=True):
            assert a[:2] == b[:2]
            assert math.isclose(a[3], b[3], rel_tol=1e-9)
            if abs(a[2]) > 1e-3:
                sign.setdefault(k, math.copysign(1, a[2] * b[2]))
            assert math.isclose(a[2], sign.get(k, 1) * b[2], rel_tol=1e-6, abs_tol=1e-6)


def vectors(seed, n, dim):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(dim, dim)) * np.linspace(3, 0.3, dim)
    return [(i, [float(c) for c in mix @ rng.normal(size=dim)], 0) for i in range(n)]


@pytest.mark.parametrize(("n", "dim", "fan_in"), [(400, 20, 2), (60, 5, 64), (9, 30, 64)])
def test_matches_the_plain_formulas(spark, n, dim, fan_in):
    rows = vectors(n, n, dim)
    check(spark.createDataFrame(rows, SCHEMA).repartition(7), rows, Params(fan_in=fan_in))


def test_copies_are_fitted_once(spark):
    rows = vectors(3, 50, 4)
    rows += [(100 + i, rows[0][1], 0) for i in range(200)] + [(7, rows[7][1], 1), (None, rows[1][1], 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    check(df, rows)
    assert {r.n for r in whitening.whiten(df).select("n").distinct().collect()} == {50}


def test_unusable_short_and_large_vectors(spark):
    rows = vectors(4, 30, 3) + [(50, None, 0), (51, [1.0, None, 2.0], 0), (52, [float("nan"), 1.0, 1.0], 0), (53, [float("inf"), 1.0, 1.0], 0), (54, [0.5], 0), (55, [], 0)]
    check(spark.createDataFrame(rows, SCHEMA), rows)
    far = rows + [(60, [1e20, 0.0, 0.0], 0)]  # beyond what a long holds: takes no part
    check(spark.createDataFrame(far, SCHEMA), rows)
    wide = vectors(5, 8, 2) + [(90, [3e14, 1.0], 0)]  # its deviation is beyond long
    got = whitening.whiten(spark.createDataFrame(wide, SCHEMA)).where("vec_id = 90").collect()
    assert got and all(r.deviation is None for r in got)


def test_too_few_vectors_and_none(spark):
    for rows in ([], [(1, [1.0, 2.0], 0)], [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], [(1, None, 0)], [(1, [], 0)]):
        assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_constant_coordinates_have_no_component(spark):
    rows = [(i, [float(i), 1.0, 2.0 * i], 0) for i in range(20)]
    check(spark.createDataFrame(rows, SCHEMA), rows)
    assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).agg(F.max("component")).first()[0] == 1


def test_clashing_columns(spark):
    rows = vectors(6, 20, 3)
    check(spark.createDataFrame(rows, SCHEMA).select("*", F.lit(1).alias("v"), F.lit("e").alias("e"), F.lit(2).alias("id"), F.lit(0).alias("n")), rows)


def test_moments_merge_as_one_stream():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(50, 4)) * 5 + 3
    whole = Moments(4)
    for v in x:
        whole.add(v)
    parts = [Moments(4) for _ in range(4)]
    for i, v in enumerate(x[:45]):
        parts[i % 3].add(v)  # the last part stays empty
    rest = Moments(4)
    for v in x[45:]:
        rest.add(v)
    total = Moments(4).merge(parts[3])
    for part in (*parts, rest):
        total.merge(part)
    assert total.n == whole.n == 50
    np.testing.assert_allclose(total.mean, x.mean(0))
    np.testing.assert_allclose(total.m2 / 50, np.cov(x.T, bias=True))
    np.testing.assert_allclose(total.m2, whole.m2)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 17, 64])
def test_symmetric_qr(n):
    rng = np.random.default_rng(n)
    a = rng.normal(size=(n, n))
    for m in (a @ a.T, a + a.T, np.zeros((n, n)), np.eye(n), np.ones((n, n)), np.diag(10.0 ** -np.arange(n))):
        values, rows = symmetric_qr(m)
        assert (np.diff(values) <= 0).all()
        np.testing.assert_allclose(rows @ rows.T, np.eye(n), atol=1e-12)
        np.testing.assert_allclose(rows @ m @ rows.T, np.diag(values), atol=1e-12 * max(1, np.abs(m).max(initial=0)) * max(1, n))
        np.testing.assert_allclose(values, np.linalg.eigvalsh(m)[::-1] if n else [], atol=1e-12 * max(1, np.abs(m).max(initial=0)) * max(1, n))


def test_whole_smallest_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    check(table, [tuple(r) for r in table.select("vec_id", "embedding").collect()])
