"""Embedding whitening: the covariance by streamed rank-one updates, its eigenvectors by the symmetric QR algorithm.

Each component c becomes the integer x = floor(scale * c) + offset. The fit list has each distinct x-vector once; copies
meet in an aggregation that combines them before its shuffle, so a vector that fills a third of all rows is one row of
the list. The list is stored; each task streams its partition through Welford's update (one rank-one update a vector:
count, mean and the sum of centred products), and hands on one row. Those rows are merged by the parallel update formula
in rounds of at most ``fan_in``, so neither a task nor the driver holds more than that many (the driver holds one).
Subtracting the offset first, exactly, keeps the numbers small; sums are exact integers.

The covariance (divisor n) is brought to tridiagonal form by Householder reflections, and that to diagonal form by
implicit QR steps with Wilkinson's shift. Components are numbered from 1 by falling eigenvalue. Every row that takes part,
copies included, is projected on the first ``components`` of them and divided by the square root of the eigenvalue. A
second pass over the fit list measures the covariance of what was whitened against the identity.

Defined results: vectors that are null, or have a null or non-finite entry or one of 2**56 or more, take no part;
null ids do; vectors shorter than the longest count as if zeros followed; repeated rows and ids are rows of their own;
components whose eigenvalue is below 1e-12 of the largest (fewer vectors than dimensions, constant or repeated
coordinates) have no row, nor has a single vector; a deviation beyond the range of long is null; extra columns are ignored,
whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from math import copysign, hypot

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from quern.llm.common import map_slices, stored

#: A component counts only above this share of the largest eigenvalue.
LEAST = 1e-12
MOMENTS = "part long, n long, sums array<string>, mean binary, m2 binary"
MOMENTS_ARROW = pa.schema({"part": pa.int64(), "n": pa.int64(), "sums": pa.list_(pa.string()), "mean": pa.binary(), "m2": pa.binary()})


@dataclass(frozen=True)
class Params:
    """scale, offset: x of a component; components: how many are returned at most; fan_in: rows merged in a task."""

    scale: int = 64
    offset: int = 1_000_000
    components: int = 16
    fan_in: int = 64


class Moments:
    """Count, exact sums, mean and centred products of vectors that came one by one."""

    def __init__(self, dim: int):
        self.n, self.sums, self.mean, self.m2 = 0, [0] * dim, np.zeros(dim), np.zeros((dim, dim))

    def add(self, x: np.ndarray) -> None:
        """Welford's update by one vector of integers or reals."""
        self.n += 1
        gap = x - self.mean
        self.mean += gap / self.n
        self.m2 += np.outer(gap, gap * ((self.n - 1) / self.n))

    def merge(self, other: Moments) -> Moments:
        """The moments of both, by the parallel update formula."""
        if self.n and other.n:
            n, gap = self.n + other.n, other.mean - self.mean
            self.m2 += other.m2 + np.outer(gap, gap * (self.n * other.n / n))
            self.mean += gap * (other.n / n)
        elif other.n:
            self.mean, self.m2 = other.mean.copy(), other.m2.copy()
        self.n += other.n
        self.sums = [a + b for a, b in zip(self.sums, other.sums, strict=True)]
        return self

    def row(self, part: int) -> dict:
        return {"part": part, "n": self.n, "sums": [str(s) for s in self.sums], "mean": self.mean.tobytes(), "m2": self.m2.tobytes()}

    @classmethod
    def of(cls, row) -> Moments:
        out = cls(len(row.sums))
        out.n, out.sums = int(row.n), [int(s) for s in row.sums]
        out.mean, out.m2 = np.frombuffer(row.mean).copy(), np.frombuffer(row.m2).copy().reshape(len(row.sums), -1)
        return out


def exact_sums(x: np.ndarray) -> list[int]:
    """Column sums of integers as Python numbers."""
    if len(x) and float(np.abs(x.astype(float)).max()) * len(x) >= 2.0**62:
        x = x.astype(object)
    return [int(s) for s in x.sum(0)]


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, off-diagonal and the transposed orthogonal matrix of a symmetric matrix, by Householder reflections."""
    a, n = a.copy(), len(a)
    turn = np.eye(n)
    least = 1e-3 * float(np.finfo(float).eps) * float(np.abs(a).max(initial=0.0))  # below all rounding
    for k in range(n - 2):
        v = a[k + 1 :, k].copy()
        length = float(np.linalg.norm(v))
        if length <= least:
            a[k + 1 :, k] = a[k, k + 1 :] = 0.0
            continue
        alpha = -copysign(length, v[0])
        v[0] -= alpha
        v /= np.linalg.norm(v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1 :, k] = a[k, k + 1 :] = 0.0
        a[k + 1, k] = a[k, k + 1] = alpha
        turn[k + 1 :] -= 2 * np.outer(v, v @ turn[k + 1 :])
    return np.diag(a).copy(), np.diag(a, 1).copy(), turn


def symmetric_qr(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as rows, by implicit QR steps with Wilkinson's shift."""
    d, e, turn = tridiagonal(np.asarray(a, float))
    eps = float(np.finfo(float).eps)
    floor = eps * eps * (float(np.abs(d).max(initial=0.0)) + float(np.abs(e).max(initial=0.0)))
    hi = len(d) - 1
    while hi > 0:
        small = np.abs(e[:hi]) <= eps * (np.abs(d[:hi]) + np.abs(d[1 : hi + 1])) + floor
        e[:hi][small] = 0.0
        if small[hi - 1]:
            hi -= 1
            continue
        cuts = np.flatnonzero(small)
        lo = int(cuts[-1]) + 1 if len(cuts) else 0
        half, b = (d[hi - 1] - d[hi]) / 2, e[hi - 1]
        shift = d[hi] - b * b / (half + copysign(hypot(half, b), half))
        x, z = d[lo] - shift, e[lo]
        for k in range(lo, hi):
            r = hypot(x, z)
            c, s = (x / r, z / r) if r else (1.0, 0.0)
            if k > lo:
                e[k - 1] = r
            first, second, off = d[k], d[k + 1], e[k]
            d[k] = c * c * first + 2 * c * s * off + s * s * second
            d[k + 1] = s * s * first - 2 * c * s * off + c * c * second
            e[k] = (c * c - s * s) * off + c * s * (second - first)
            x = e[k]
            if k < hi - 1:
                z = s * e[k + 1]
                e[k + 1] *= c
            turn[k], turn[k + 1] = c * turn[k] + s * turn[k + 1], c * turn[k + 1] - s * turn[k]
    order = np.argsort(-d, kind="stable")
    return d[order], turn[order]


@dataclass(frozen=True)
class Fit:
    """What whitening needs: the count and exact sums of the fit list, eigenvalues, components as rows, and what the check of its result found."""

    n: int
    sums: tuple[int, ...]
    offset: int
    values: np.ndarray
    components: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exactly: as int64 where that is wide enough, else as Python's integers."""
        most = max(float(np.abs(x.astype(float)).max(initial=0.0)) * self.n, max(map(abs, self.sums), default=0))
        kind = np.int64 if most < 2.0**61 else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred.astype(float) / self.n) @ self.components.T / np.sqrt(self.values)


def matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column(batch.schema.get_field_index("v")).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dim)


def merged_moments(parts: Iterable) -> Moments:
    first, *rest = map(Moments.of, parts)
    for other in rest:
        first.merge(other)
    return first


def moments(rows: DataFrame, dim: int, offset: int, fit: Fit | None, fan_in: int) -> Moments | None:
    """Of all vectors v less the offset or, with a fit, of what they are whitened to. None without rows."""
    width = dim if fit is None else len(fit.values)

    def run(batches):
        total = Moments(width)
        for batch in batches:
            x = matrix(batch, dim)
            if fit is None:
                total.sums = [a + b for a, b in zip(total.sums, exact_sums(x), strict=True)]
            for v in (x - offset).astype(float) if fit is None else fit.whitened(fit.centred(x)):
                total.add(v)
        if total.n:
            yield pa.RecordBatch.from_pylist([total.row(TaskContext.get().partitionId())], MOMENTS_ARROW)

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("part")
        return pd.DataFrame([merged_moments(frame.itertuples()).row(int(frame.part.iloc[0]))])

    parts = stored(rows.select("v").mapInArrow(run, MOMENTS), "moments")
    n = parts.count()
    while n > 1:
        groups = -(-n // fan_in)
        parts = stored(parts.groupBy(F.pmod("part", F.lit(groups))).applyInPandas(merge, MOMENTS), "moments")
        n = parts.count()
    found = parts.collect()
    return Moments.of(found[0]) if found else None


def integers(vectors: DataFrame, params: Params, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """id and v, the integers of each vector that takes part, and how many each has."""
    fits = F.forall("e", lambda c: F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < 2.0**56), F.lit(False)))
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("e")).where(F.coalesce(fits, F.lit(False)))
    dim = rows.agg(F.max(F.size("e")).alias("d")).first()["d"] or 0
    x = F.transform("e", lambda c: F.floor(F.lit(float(params.scale)) * c.cast("double")).cast("long") + F.lit(params.offset).cast("long"))
    return rows.select("id", F.concat(x, F.array_repeat(F.lit(params.offset).cast("long"), F.lit(dim) - F.size("e"))).alias("v")), dim


def fit(v: DataFrame, dim: int, params: Params = Params()) -> Fit | None:
    """The components of the distinct vectors v of a DataFrame; None where there is no row."""
    distinct = stored(v.select("v").distinct(), "fit_list")
    total = moments(distinct, dim, params.offset, None, params.fan_in)
    if total is None:
        return None
    covariance = total.m2 / total.n
    values, components = symmetric_qr(covariance)
    count = int(((values > LEAST * values[:1]) & (values > 0))[: params.components].sum())
    found = Fit(total.n, tuple(total.sums), params.offset, values[:count], components[:count], values[:count] / np.trace(covariance) if count else values[:0])
    if not count:
        return found
    after = moments(distinct, dim, params.offset, found, params.fan_in)
    error = float(np.abs(after.m2 / after.n - np.eye(count)).max())
    return Fit(found.n, found.sums, found.offset, found.values, found.components, found.explained, error)


def whiten(vectors: DataFrame, params: Params = Params(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of each row that takes part and each component."""
    v, dim = integers(vectors, params, id_col, vector_col)
    kinds = {"component": IntegerType(), "n": LongType(), "deviation": LongType(), "whitened": DoubleType(), "explained": DoubleType(), "identity_error": DoubleType()}
    schema = StructType([StructField("vec_id", v.schema["id"].dataType), *(StructField(k, t) for k, t in kinds.items())])
    found = fit(v, dim, params) if dim else None
    if found is None or not len(found.values):
        return vectors.sparkSession.createDataFrame([], schema)
    arrow, count = to_arrow_schema(schema), len(found.values)

    def make():
        def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
            centred = found.centred(matrix(batch, dim))
            wide = float(np.abs(centred.astype(float)).max()) ** 2 * dim >= 2.0**62
            squares = ((centred.astype(object) if wide else centred) ** 2).sum(1)
            deviation = [int(s) if s < 2**63 else None for s in squares.tolist()]
            take = np.repeat(np.arange(batch.num_rows), count)
            columns = [
                batch.column(batch.schema.get_field_index("id")).take(pa.array(take)),
                pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), batch.num_rows)),
                pa.array(np.full(len(take), found.n, np.int64)),
                pa.array(deviation, pa.int64()).take(pa.array(take)),
                pa.array(found.whitened(centred).ravel()),
                pa.array(np.tile(found.explained, batch.num_rows)),
                pa.array(np.full(len(take), found.identity_error)),
            ]
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        return kernel

    return map_slices(v, arrow, schema, make)
