"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; every other text of the sample is unlabelled, toxic or not. With the class
prior pi, the risk of a linear scorer is

    pi * R_p(+1) + max(0, R_u(-1) - pi * R_p(-1))

where R_p and R_u are mean sigmoid losses over positives and unlabelled texts. When a batch's bracket is negative, the
step ascends on it instead, so that a flexible model cannot drive the estimated negative risk below zero.

A text's features are its distinct lower-cased words and their 4 and 5 character prefixes, hashed. Labels, language,
source and id are never features. The fit is made in numpy on the driver, from a sample that a hash of the id picks,
alike at every input size: at most ``max_positive`` (3,000) texts confirmed as toxic and ``max_unlabelled`` (9,000)
others, each id once. All of their features that are strong enough are fitted. The class prior is counted
over all labels of the training folds. Scoring reads all texts whole in one pass, without a shuffle, and a task holds
the texts of a slice of rows.

Defined results: null and empty texts score as the bias alone; without positives the score is the class prior, 0;
repeated label rows of an id count as toxic if any is; of texts that repeat an id the one of the least hash is learned
from, and each is scored; equal texts score equal; labels without a text, null labels and null ids are not learned
from; extra columns are ignored where the model is fitted and kept where documents are returned, and a score column
that clashes with one raises ValueError; an empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from quern.llm.common import Memo, fresh, map_slices, trim_driver

STRIP = ".,;:!?\"'()[]{}<>«»„“”…*#$%&-_"
PREFIXES = (4, 5)
SPACE = 1 << 24
THRESHOLD = 0.7
MEMO_WORDS = 120_000


@dataclass(frozen=True)
class Params:
    max_positive: int = 3000
    max_unlabelled: int = 9000
    min_texts: int = 3
    min_strength: float = 3.0
    epochs: int = 60
    batch: int = 1500
    rate: float = 0.05
    decay: float = 1e-4
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """Weights by hashed feature, the bias, and the class prior the fit used."""

    weights: dict[int, float]
    bias: float
    prior: float


def features_of(word: str) -> tuple[int, ...]:
    """The hashed features of one word: itself and its prefixes; none if nothing is left of it."""
    core = word.strip(STRIP)
    if not core:
        return ()
    named = [core, *(f"{core[:n]}\0{n}" for n in PREFIXES if len(core) >= n)]
    return tuple(zlib.crc32(x.encode()) % SPACE for x in named)


def words_of(text: str | None) -> set[str]:
    return set((text or "").lower().split())


def prior_of(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic") -> tuple[float, int]:
    """The share of toxic rows among all labelled ids, and the number of toxic ones."""
    per_id = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).alias("y"))
    n, y = per_id.agg(F.count("*"), F.sum(F.col("y").cast("long"))).first()
    return ((y or 0) / n if n else 0.0), int(y or 0)


def sample(docs: DataFrame, labels: DataFrame, params: Params, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Hashed features of the positive and of the unlabelled texts; at most the two bounds of rows come to the driver.

    Unlabelled are the texts without a confirmed toxic label, whether or not another label was ever given.
    """
    toxic = labels.where(F.col(label_col) == 1).select(F.col(id_col).alias("id")).distinct().withColumn("toxic", F.lit(True))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("id").isNotNull())
    order = F.xxhash64("id", F.lit(11))
    # Ids alone are ordered, each once; only the texts of those picked are read again, and one of each id is taken.
    known = texts.select("id").distinct().join(toxic, "id", "left")
    picked = known.where("toxic").orderBy(order, "id").limit(params.max_positive).unionByName(known.where("toxic IS NULL").orderBy(order, "id").limit(params.max_unlabelled))
    rows = texts.join(F.broadcast(picked), "id").groupBy("id", "toxic").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("t")).select("toxic", "t.text", order.alias("o"), "id")

    def make():
        memo = Memo(features_of, MEMO_WORDS)

        def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [np.unique(np.fromiter((f for w in words_of(x) for f in memo[w]), np.int32)) for x in batch.column("text").to_pylist()]
            return pa.RecordBatch.from_pydict({"toxic": batch.column("toxic"), "o": batch.column("o"), "features": pa.array([x.tobytes() for x in found], pa.binary())})

        return kernel

    schema = pa.schema([("toxic", pa.bool_()), ("o", pa.int64()), ("features", pa.binary())])
    got = map_slices(rows, schema, "toxic boolean, o long, features binary", make).collect()
    got.sort(key=lambda r: (r.o, r.features))
    return [np.frombuffer(r.features, np.int32) for r in got if r.toxic], [np.frombuffer(r.features, np.int32) for r in got if not r.toxic]


def select_features(pos: list[np.ndarray], unl: list[np.ndarray], prior: float, params: Params) -> np.ndarray:
    """The features that speak for toxicity, strongest first (difference of shares in standard errors).

    A feature of toxic texts alone is 1 / prior times as frequent among positives as among unlabelled texts, since the
    latter hold toxic texts too; one that only comes along with topic, language or length is hardly more frequent. Kept
    are those more frequent by the geometric mean of 1 and 1 / prior.
    """
    seen = [np.unique(np.concatenate(x) if x else np.empty(0, np.int32), return_counts=True) for x in (pos, unl)]
    names = seen[0][0]
    count = np.zeros((2, len(names)))
    count[0] = seen[0][1]
    shared = np.isin(seen[1][0], names, assume_unique=True)
    count[1][np.searchsorted(names, seen[1][0][shared])] = seen[1][1][shared]
    p, u = count[0] / len(pos), count[1] / len(unl)
    both = count.sum(0) / (len(pos) + len(unl))
    strength = (p - u) / np.sqrt(both * (1 - both) * (1 / len(pos) + 1 / len(unl)) + 1e-12)
    kept = (count[0] >= params.min_texts) & (strength >= params.min_strength) & (p >= u / math.sqrt(prior))
    return np.sort(names[kept])


class _Rows:
    """Binary feature rows in compressed form."""

    def __init__(self, rows: list[np.ndarray], names: np.ndarray):
        kept = [np.searchsorted(names, r[np.isin(r, names, assume_unique=True)]) for r in rows]
        self.start = np.concatenate([[0], np.cumsum([len(x) for x in kept])])
        self.column = np.concatenate(kept).astype(np.int64) if kept else np.empty(0, np.int64)

    def __len__(self) -> int:
        return len(self.start) - 1

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row number within rows, column) of every entry."""
        n = self.start[rows + 1] - self.start[rows]
        owner = np.repeat(np.arange(len(rows)), n)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        return owner, self.column[np.repeat(self.start[rows], n) + within]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def risk_gradient(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[float, np.ndarray, np.ndarray]:
    """The non-negative risk and what to step along for each positive and unlabelled score.

    The sigmoid loss is l(z, y) = sigmoid(-y z). Where the negative part is below zero its gradient is turned round.
    """
    sp, su = _sigmoid(zp), _sigmoid(zu)
    positive, negative = prior * np.mean(1 - sp), np.mean(su) - prior * np.mean(sp)
    dp, du = sp * (1 - sp) / len(zp), su * (1 - su) / len(zu)
    if negative < 0:
        return positive, prior * dp, -du
    return positive + negative, -2 * prior * dp, du


def fit(pos: list[np.ndarray], unl: list[np.ndarray], prior: float, params: Params) -> Model:
    """Adam on the non-negative risk, over mini-batches that keep the sample's proportion of positives."""
    if not pos or not unl or prior <= 0:
        return Model({}, -40.0 if prior <= 0 else math.log(prior / max(1e-9, 1 - prior)), prior)
    names = select_features(pos, unl, prior, params)
    rows_p, rows_u = _Rows(pos, names), _Rows(unl, names)
    rng = np.random.default_rng(params.seed)
    size = len(names) + 1
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    w[-1] = -1.0
    steps = max(1, math.ceil((len(pos) + len(unl)) / params.batch))
    n_step = 0
    for epoch in range(params.epochs):
        parts_p, parts_u = (np.array_split(rng.permutation(len(r)), steps) for r in (rows_p, rows_u))
        for part_p, part_u in zip(parts_p, parts_u, strict=True):
            if not len(part_p) or not len(part_u):
                continue
            (op, cp), (ou, cu) = rows_p.take(part_p), rows_u.take(part_u)
            zp = np.bincount(op, w[cp], len(part_p)) + w[-1]
            zu = np.bincount(ou, w[cu], len(part_u)) + w[-1]
            _, dp, du = risk_gradient(zp, zu, prior)
            g = np.bincount(cp, dp[op], size) + np.bincount(cu, du[ou], size) + params.decay * w
            g[-1] += dp.sum() + du.sum() - params.decay * w[-1]
            n_step += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            rate = params.rate * (1 - epoch / params.epochs)
            w -= rate * (m / (1 - 0.9**n_step)) / (np.sqrt(v / (1 - 0.999**n_step)) + 1e-8)
    return Model({int(k): float(x) for k, x in zip(names, w[:-1], strict=True) if abs(x) > 1e-6}, float(w[-1]), prior)


def train(docs: DataFrame, labels: DataFrame, params: Params = Params(), **columns: str) -> Model:
    """Fit on the labels given; keep rows that must stay unseen out of both tables."""
    prior, n = prior_of(labels, columns.get("id_col", "doc_id"), columns.get("label_col", "toxic"))
    pos, unl = sample(docs, labels, params, **columns) if n else ([], [])
    model = fit(pos, unl, prior, params)
    del pos, unl
    trim_driver(docs.sparkSession)
    return model


def scorer(model: Model):
    """text -> score, for one task."""
    memo = Memo(lambda word: sum(model.weights.get(f, 0.0) for f in features_of(word)), MEMO_WORDS)

    def score(text: str | None) -> float:
        z = model.bias + math.fsum(map(memo.__getitem__, words_of(text)))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))

    return score


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """docs with the score of each whole text added as the last column, under a name new to docs."""
    if name in docs.columns:
        raise ValueError(f"docs already has a column {name}")
    at, schema = docs.columns.index(text_col), to_arrow_schema(docs.schema)
    out = schema.append(pa.field(name, pa.float64()))
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        of = scorer(shipped.value)

        def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores = pa.array([of(x) for x in batch.column(at).to_pylist()], pa.float64())
            return pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(batch.columns, schema, strict=True)), scores], schema=out)

        return kernel

    return map_slices(docs, out, StructType([*docs.schema, StructField(name, DoubleType())]), make)


def filter_documents(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    name = fresh(docs, "score")
    return score(docs, model, text_col, name).where(F.col(f"`{name}`") < threshold).drop(name)
