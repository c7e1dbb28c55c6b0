"""Exact top-k search by inner product, over vectors in order of their length.

Vectors are integers: each component x becomes floor(scale * x). Candidates are sorted by length, longest first, cut
into blocks and stored; queries are dealt into groups by a hash. A task holds a group and meets a share of the blocks,
longest first.

* A query's k-th best score among the longest block's candidates is its first threshold, raised as blocks go by.
* A block whose longest vector cannot reach a query's threshold is passed over for that query (Cauchy-Schwarz), and is
  not looked at any further when that holds for all.
* Vectors are rotated by the right singular vectors of the candidates, so that the first coordinates hold most of a
  score. After some coordinates, the partial sum plus the product of both remaining lengths bounds the score; pairs
  bounded below the threshold go. Rounding is covered by a slack far above its size.
* What survives is scored in exact integers (float64 products of integers below 2**53 are exact), so the result does
  not depend on the rotation, the blocks or the order in which they come.

Ties go to the smaller id. Each block returns at most k rows a query; those are merged by a ranked window. A task reads
some ``SHARE_BLOCKS`` blocks, whatever the size of the table.

Defined results: vectors that are null or have null or non-finite components take no part, neither do null ids;
vectors shorter than the longest count as if zeros followed; rows are numbered, so rows that repeat an id, or all of
another row, are candidates and queries of their own, and only a query's own row is no candidate of it; fewer
candidates than k are all returned; extra columns are ignored, whatever their names; an empty table gives no rows;
components whose products could pass 2**53 raise ValueError.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quern.llm.common import stored

CANDIDATE_BLOCK, QUERY_GROUP = 4096, 2048
#: Blocks that a task meets, about; a task of a small table meets fewer.
SHARE_BLOCKS = 32
#: After how many rotated coordinates pairs are pruned, as shares of all.
STAGES = (0.25, 0.5)
#: Of the pairs that a stage leaves, more than this share are scored all at once rather than one by one.
DENSE = 0.1
RESULT = "query_id long, rank int, vec_id long, score long"


def usable(vector: Column) -> Column:
    """The vector is there and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def integers(vectors: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, v (integers as doubles) and norm2 of the vectors that take part."""
    v = F.transform(F.col("x"), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("x")).where(F.col("vec_id").isNotNull() & usable(F.col("x")))
    return rows.select("vec_id", v.alias("v")).withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))


def packed(rows: DataFrame, dim: int, most: int) -> DataFrame:
    """Rows of each partition, in their order, as blocks of at most ``most``: block, ids, matrix (int32, row by row)."""

    def run(batches):
        at, n, held = TaskContext.get().partitionId(), 0, []

        def block(parts):
            nonlocal n
            ids = np.concatenate([p[0] for p in parts])
            matrix = np.concatenate([p[1] for p in parts])
            n += 1
            return pa.RecordBatch.from_pydict({"block": pa.array([at * (1 << 20) + n - 1]), "ids": pa.array([ids.tobytes()], pa.binary()), "matrix": pa.array([matrix.astype(np.int32).tobytes()], pa.binary())})

        for batch in batches:
            lists = batch.column("v")
            sizes = np.diff(lists.offsets.to_numpy())
            matrix = np.zeros((batch.num_rows, dim))
            matrix[np.arange(dim) < sizes[:, None]] = lists.flatten().to_numpy()
            ids = batch.column("vec_id").to_numpy()
            for start in range(0, batch.num_rows, most):
                held.append((ids[start : start + most], matrix[start : start + most]))
                while (have := sum(len(p[0]) for p in held)) >= most:
                    over = have - most
                    last = held[-1]
                    cut = len(last[0]) - over
                    held[-1] = (last[0][:cut], last[1][:cut])
                    yield block(held)
                    held = [(last[0][cut:], last[1][cut:])] if over else []
        if held:
            yield block(held)

    return rows.mapInArrow(run, "block long, ids binary, matrix binary")


def rotation(blocks: DataFrame, dim: int) -> np.ndarray:
    """The right singular vectors of all candidates, by the eigenvectors of their products' sum (dim * dim numbers)."""

    def run(batches):
        total = np.zeros((dim, dim))
        for batch in batches:
            for raw in batch.column("matrix").to_pylist():
                m = np.frombuffer(raw, np.int32).reshape(-1, dim).astype(float)
                total += m.T @ m
        yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(dim * dim), pa.int64()), "x": pa.array(total.ravel(), pa.float64())})

    sums = blocks.select("matrix").mapInArrow(run, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).collect()
    gram = np.zeros(dim * dim)
    for r in sums:
        gram[r["at"]] = r.x
    values, vectors = np.linalg.eigh(gram.reshape(dim, dim))
    return np.ascontiguousarray(vectors[:, np.argsort(-values)])


class Side:
    """A block's vectors with what pruning needs: rotated coordinates and remaining lengths after each stage."""

    def __init__(self, rows: np.ndarray, ids: bytes, matrix: bytes, turn: np.ndarray):
        self.rows, self.turn = rows, turn
        self.ids = np.frombuffer(ids, np.int64)
        self.exact = np.frombuffer(matrix, np.int32).reshape(-1, len(turn)).astype(float)
        self.norm = np.sqrt((self.exact**2).sum(1))
        self.cuts = sorted({max(1, int(len(turn) * s)) for s in STAGES})

    @cached_property
    def turned(self) -> np.ndarray:
        return self.exact @ self.turn

    @cached_property
    def rest(self) -> list[np.ndarray]:
        return [np.sqrt((self.turned[:, c:] ** 2).sum(1)) for c in self.cuts]


def best(queries: Side, block: Side, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate row, score) of the at most k best candidates of a block for each query, none below least."""
    none = (np.empty(0, np.int64),) * 3
    slack = 1e-6 * (queries.norm + 1) * (block.norm.max() + 1)
    live = np.flatnonzero(queries.norm * block.norm.max() + slack >= least)
    if not len(live):
        return none
    want = (least - slack)[live, None]
    keep, sums, done = None, np.zeros((len(live), len(block.ids))), 0
    for cut, rest_q, rest_c in zip(queries.cuts, queries.rest, block.rest, strict=True):
        sums += queries.turned[live, done:cut] @ block.turned[:, done:cut].T
        done = cut
        keep = sums + rest_q[live, None] * rest_c >= want
        if not keep.any():
            return none
        alive = keep.any(1)
        if not alive.all():
            live, sums, keep, want = live[alive], sums[alive], keep[alive], want[alive]
        if keep.mean() <= DENSE:
            break
    if keep.mean() <= DENSE:
        q, c = np.nonzero(keep)
        scores = np.concatenate([np.einsum("ij,ij->i", queries.exact[live[q[i : i + 65536]]], block.exact[c[i : i + 65536]]) for i in range(0, len(q), 65536)])
    else:
        full = queries.exact[live] @ block.exact.T
        full[queries.rows[live, None] == block.rows] = -np.inf
        top = np.partition(full, -min(k, full.shape[1]), axis=1)[:, -min(k, full.shape[1])]
        q, c = np.nonzero(keep & (full >= top[:, None]))
        scores = full[q, c]
    q = live[q]
    good = (scores >= least[q]) & (queries.rows[q] != block.rows[c])
    q, c, scores = q[good], c[good], scores[good]
    order = np.lexsort((block.ids[c], -scores, q))
    q, c, scores = q[order], c[order], scores[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    return tuple(x[place < k] for x in (q, c, scores))


def raised(least: np.ndarray, q: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """least, raised to the k-th score of each query that has k."""
    out = least.copy()
    rows, n = np.unique(q, return_counts=True)
    lowest = np.full(len(least), np.inf)
    np.minimum.at(lowest, q, scores)
    full = rows[n >= k]
    out[full] = np.maximum(out[full], lowest[full])
    return out


def search(vectors: DataFrame, k: int = 5, scale: int = 256, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k highest inner products of every row whose id is divisible by ``every``, against all other rows."""
    spark = vectors.sparkSession
    rows = integers(vectors, scale, id_col, vector_col)
    is_query = F.col("vec_id") % every == 0
    n, n_queries, dim, most = rows.agg(F.count("*"), F.count_if(is_query), F.max(F.size("v")), F.max("norm2")).first()
    if not n_queries or not dim:
        return spark.createDataFrame([], RESULT)
    if most >= 2.0**53:
        raise ValueError("components are too large for exact scores")
    order = [F.desc("norm2"), F.asc("vec_id")]
    ranged = rows.repartitionByRange(max(1, -(-n // CANDIDATE_BLOCK)), *order).sortWithinPartitions(*order)
    candidates = stored(packed(ranged.select("vec_id", "v"), dim, CANDIDATE_BLOCK), "candidates")
    n_blocks = candidates.count()
    turn = spark.sparkContext.broadcast(rotation(candidates, dim))  # dim * dim numbers
    head = spark.sparkContext.broadcast(tuple(candidates.orderBy("block").first()))  # one block
    size = CANDIDATE_BLOCK

    def asked(batches):
        for batch in batches:
            for block, ids, matrix in zip(*(batch.column(c).to_pylist() for c in ("block", "ids", "matrix")), strict=True):
                found = np.frombuffer(ids, np.int64)
                at = np.flatnonzero(found % every == 0)
                vectors = np.frombuffer(matrix, np.int32).reshape(-1, dim)[at]
                yield pa.RecordBatch.from_pydict({"block": pa.array(block * size + at), "ids": pa.array([x.tobytes() for x in found[at]], pa.binary()), "matrix": pa.array([x.tobytes() for x in vectors], pa.binary())})

    # Every group of queries meets every share of the blocks in one cell; its queries come first, then the blocks by length.
    groups = -(-n_queries // QUERY_GROUP)
    shares = min(n_blocks, max(-(-n_blocks // SHARE_BLOCKS), int(spark.conf.get("spark.sql.shuffle.partitions")) // groups))
    each_group, each_share = (F.explode(F.sequence(F.lit(0), F.lit(x - 1))) for x in (groups, shares))
    left = candidates.select(each_group.alias("group"), F.pmod(F.xxhash64("block"), F.lit(shares)).cast("int").alias("share"), F.lit(1).alias("kind"), "block", "ids", "matrix")
    right = candidates.mapInArrow(asked, "block long, ids binary, matrix binary").select(F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("group"), each_share.alias("share"), F.lit(0).alias("kind"), "block", "ids", "matrix")
    cells = left.unionByName(right).repartition(groups * shares, "group", "share").sortWithinPartitions("group", "share", "kind", "block")

    def block_of(number: int, ids: bytes, matrix: bytes) -> Side:
        return Side(number * size + np.arange(len(ids) // 8), ids, matrix, turn.value)

    def scored(batches):
        cell, held, queries, least = None, [], None, None
        for batch in batches:
            for i in range(batch.num_rows):
                group, share, kind, number, ids, matrix = (batch.column(c)[i].as_py() for c in ("group", "share", "kind", "block", "ids", "matrix"))
                if cell != (group, share):
                    cell, held, queries = (group, share), [], None
                if kind == 0:
                    held.append((number, ids, matrix))
                    continue
                if not held:  # no query has this group's number
                    continue
                if queries is None:
                    queries = Side(np.array([h[0] for h in held]), *(b"".join(h[x] for h in held) for x in (1, 2)), turn.value)
                    least = np.full(len(held), -np.inf)
                    q, _, s = best(queries, block_of(*head.value), least, k)
                    least = raised(least, q, s, k)
                block = block_of(number, ids, matrix)
                q, c, s = best(queries, block, least, k)
                least = raised(least, q, s, k)
                if len(q):
                    yield pa.RecordBatch.from_pydict({"query": pa.array(queries.rows[q]), "query_id": pa.array(queries.ids[q]), "vec_id": pa.array(block.ids[c]), "score": pa.array(s.astype(np.int64))})

    found = cells.mapInArrow(scored, "query long, query_id long, vec_id long, score long")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
