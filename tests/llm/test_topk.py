import math
import random

import duckdb
import numpy as np
import pytest

from quern.llm import queries, topk

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, k=5, every=50, scale=256):
    good = [(i, tuple(math.floor(scale * x) for x in v)) for i, v, *_ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dim = max((len(v) for _, v in good), default=0)
    good = [(i, v + (0,) * (dim - len(v))) for i, v in good]
    out = []
    for a, (i, q) in enumerate(good):
        if i % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(q, c, strict=True)), j) for b, (j, c) in enumerate(good) if a != b)
            out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in topk.search(df).collect())


def vectors(seed, n, dim=8, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(0, 1, dim) * (1 + spread * rng.random())], 0) for i in range(n)]


@pytest.mark.parametrize(("n", "block"), [(400, 16), (400, 4096), (3, 4096), (1, 4096)])
def test_matches_brute_force(spark, monkeypatch, n, block):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_GROUP", 4)
    rows = vectors(1, n)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)


def test_ties_nulls_repeats_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 32)
    rng = random.Random(2)
    same = [1.0, -0.5, 0.25]
    rows = [(i, same if rng.random() < 0.6 else [rng.choice([-1.0, 0.0, 1.0]) for _ in range(3)], 0) for i in range(300)]
    rows += [(1000, None, 0), (1001, [None, 1.0, 1.0], 0), (1002, [math.nan, 1.0, 1.0], 0), (1050, [math.inf, 0.0, 0.0], 0), (None, same, 0), (0, rows[0][1], 0), (7, rows[7][1], 3), (1100, [2.0], 0), (1150, [], 0), (1200, [0.0, 0.0, 0.0], 0)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_empty_and_query_free_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert topk.search(df).count() == 0 and topk.search(df).columns == ["query_id", "rank", "vec_id", "score"]
    assert topk.search(spark.createDataFrame([(1, [1.0], 0)], SCHEMA)).count() == 0


def test_scores_that_floats_cannot_hold_are_refused(spark):
    with pytest.raises(ValueError, match="exact"):
        topk.search(spark.createDataFrame([(0, [1e9, 1e9], 0), (1, [1.0, 1.0], 0)], SCHEMA))


def test_pruning_drops_pairs_but_no_results():
    rng = np.random.default_rng(3)
    base = np.floor(rng.normal(0, 60, (600, 32)) * (0.1 + np.arange(32, 0, -1) / 8) ** 1.5)
    turn = np.linalg.svd(base, full_matrices=False)[2].T
    sides = [topk.Side(np.arange(a, b), np.arange(a, b, dtype=np.int64).tobytes(), base[a:b].astype(np.int32).tobytes(), np.ascontiguousarray(turn)) for a, b in ((0, 100), (100, 600))]
    full = base[:100] @ base[100:].T
    least = np.sort(full, 1)[:, -5]
    q, c, s = topk.best(*sides, least, 5)
    assert len(q) == 500 and (np.sort(s.reshape(100, 5), 1) == np.sort(full, 1)[:, -5:]).all()
    cut = sides[0].cuts[0]
    bound = sides[0].turned[:, :cut] @ sides[1].turned[:, :cut].T + np.outer(sides[0].rest[0], sides[1].rest[0])
    assert (bound >= least[:, None]).mean() < 0.5 and (bound >= full - 1e-6).all()


def test_rows_of_one_id_are_rows_of_their_own(spark, monkeypatch):
    rows = [(50 * (i % 2), [float(9 + i // 3), 0.0], i) for i in range(16)] + [(i, [float(i), 1.0], 0) for i in range(1, 8)]
    for block in (3, 4096):
        monkeypatch.setattr(topk, "CANDIDATE_BLOCK", block)
        assert found(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)


def test_sql_on_repeated_rows(spark, tmp_path):
    rows = [(i % 120, [float(x) for x in np.random.default_rng(i % 140).normal(0, 1, 4)], 0) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    assert sorted(con.sql(queries.OP7_SQL).select("query_id, rank, vec_id, score").fetchall()) == found(df) == brute(rows)
