"""The driver tables in the roles of the engine's inputs, as DataFrames and as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import scalars
from quern.operators import augment, duplicates, inspection, master, split
from quern.sources.tables import table

FIRST, SECOND = "A", "B"
UNSUPPORTED = ("src3", "src13")
LEAST_CHARS = 60
SEED = 42
HAMMING = 24
ORDER = ["corpus", "klass", "id"]
TARGET = 600

ITEMS_SQL = f"""items AS (SELECT doc_id AS id, lang AS klass, text AS content, CASE WHEN CAST(substr(source, 4) AS INTEGER) < 10 THEN 'A' ELSE 'B' END AS corpus,
  sha256(text) AS fingerprint, source, n_chars, n_chars >= {LEAST_CHARS} AS is_valid,
  CASE WHEN source IN {UNSUPPORTED} THEN 'unsupported' WHEN n_chars < {LEAST_CHARS} THEN 'corrupt' ELSE 'valid' END AS status FROM documents)"""
GROUPS_SQL = """found AS (SELECT fingerprint, count(*) AS n, count_if(corpus = 'A')::BIGINT AS n_first, count_if(corpus = 'B')::BIGINT AS n_second, count(DISTINCT klass) AS n_classes,
  min(id) AS first_id, CASE WHEN count_if(corpus = 'B') = 0 THEN 'within-A' WHEN count_if(corpus = 'A') = 0 THEN 'within-B' ELSE 'cross-dataset' END AS dup_type
  FROM items WHERE fingerprint IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"""
MANIFEST_SQL = """ranked AS (SELECT *, row_number() OVER w AS place, first_value(id) OVER w AS first_id FROM items
  WINDOW w AS (PARTITION BY coalesce(fingerprint, 'id:' || id) ORDER BY corpus, klass, id)),
entries AS (SELECT id, klass, corpus, fingerprint, source, n_chars, status, place > 1 OR is_valid AS is_valid, place > 1 AS is_duplicate,
  CASE WHEN place > 1 THEN first_id END AS canonical_id, place = 1 AND is_valid AS include_in_master FROM ranked)"""
SPLIT_SQL = f"""placed AS (SELECT *, row_number() OVER (PARTITION BY klass ORDER BY sha256('{SEED}|' || id), id) AS place, count(*) OVER (PARTITION BY klass) AS n FROM entries WHERE include_in_master),
sized AS (SELECT *, greatest(1, round_even(n * 0.1::DOUBLE, 0))::BIGINT AS v FROM placed),
cut AS (SELECT *, CASE WHEN n - 2 * v < 1 THEN 1 ELSE n - 2 * v END AS n_train, CASE WHEN n - 2 * v < 1 AND 2 * v > n - 1 THEN greatest(1, (n - 1) // 2) ELSE v END AS n_val FROM sized),
split AS (SELECT *, CASE WHEN place <= n_train THEN 'train' WHEN place <= n_train + n_val THEN 'validation' ELSE 'test' END AS split FROM cut)"""
BASE_SQL = f"WITH {ITEMS_SQL}, {GROUPS_SQL}, {MANIFEST_SQL}, {SPLIT_SQL}\n"


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as labelled items of two corpora, with fingerprint and status."""
    docs = table(spark, sf_dir, "documents")
    corpus = F.when(F.substring("source", 4, 10).cast("int") < 10, FIRST).otherwise(SECOND)
    found = docs.select(F.col("doc_id").alias("id"), F.col("lang").alias("klass"), F.col("text").alias("content"), corpus.alias("corpus"), scalars.content_hash(F.col("text").cast("binary")).alias("fingerprint"), "source", "n_chars")
    found = found.withColumn("is_valid", F.col("n_chars") >= LEAST_CHARS)
    return inspection.with_status(found, ~F.col("source").isin(*UNSUPPORTED), F.col("is_valid"))


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.groups(items(spark, sf_dir), FIRST, SECOND)


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return master.manifest(items(spark, sf_dir), ORDER)


def splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.assign(entries(spark, sf_dir).where("include_in_master"), SEED)


def train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits(spark, sf_dir).where("split = 'train'")


def plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return augment.plan(train(spark, sf_dir), TARGET, SEED, ORDER)


HASHES_SQL = """v AS (SELECT vec_id AS id, label AS klass, CASE WHEN vec_id % 2 = 0 THEN 'A' ELSE 'B' END AS corpus, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
h AS (SELECT *, list_median(e) AS m FROM v),
hashes AS (SELECT id, klass, corpus, id::VARCHAR AS fingerprint,
  (list_sum(list_transform(range(0, 63), lambda i: CASE WHEN e[i + 1] > m THEN (1::HUGEINT << i::INTEGER) ELSE 0::HUGEINT END)) - CASE WHEN e[64] > m THEN (1::HUGEINT << 63) ELSE 0 END)::BIGINT AS hash,
  list_sum(list_transform(range(0, 63), lambda i: CASE WHEN e[i + 2] > e[i + 1] THEN (1::HUGEINT << i::INTEGER) ELSE 0::HUGEINT END))::BIGINT AS dhash FROM h)"""
PAIRS_SQL = f"""pairs AS (SELECT a.klass, a.id AS first_id, b.id AS second_id, bit_count(xor(a.hash, b.hash))::INTEGER AS distance FROM hashes a JOIN hashes b
  ON a.klass = b.klass AND a.corpus = 'A' AND b.corpus = 'B' AND a.fingerprint IS DISTINCT FROM b.fingerprint AND bit_count(xor(a.hash, b.hash)) <= {HAMMING})"""


def hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings as perceptual coefficients: median and gradient hashes."""
    values = F.transform("embedding", lambda x: x.cast("double"))
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("klass"), F.when(F.col("vec_id") % 2 == 0, FIRST).otherwise(SECOND).alias("corpus"), F.col("vec_id").cast("string").alias("fingerprint"), values.alias("e"))
    return rows.select("id", "klass", "corpus", "fingerprint", scalars.median_hash(F.col("e")).alias("hash"), scalars.gradient_hash(F.col("e")).alias("dhash"))


def near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.near_pairs(hashes(spark, sf_dir), FIRST, SECOND, HAMMING)


PREDICTIONS_SQL = """e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
c AS (SELECT label AS l, i, round(avg(x), 9) AS m FROM e GROUP BY 1, 2),
s AS (SELECT vec_id AS id, label AS y_true, l, round(sum(x * m), 6) AS score FROM e JOIN c USING (i) GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, l) AS k, exp(score) / sum(exp(score)) OVER (PARTITION BY id) AS p FROM s),
predictions AS (SELECT id, any_value(y_true) AS y_true, any_value(l) FILTER (k = 1) AS y_pred, round(any_value(p) FILTER (k = 1), 6) AS confidence,
  round(any_value(p) FILTER (l = y_true), 6) AS p_true, (id % 3)::INTEGER AS run, CASE WHEN id % 10 < 8 THEN 'train' WHEN id % 10 = 8 THEN 'validation' ELSE 'test' END AS split FROM r GROUP BY id),
cells AS (SELECT y_true, y_pred, count(*) AS n FROM predictions GROUP BY 1, 2),
sides AS (SELECT y_true AS label, n AS support, 0 AS predicted, CASE WHEN y_true = y_pred THEN n ELSE 0 END AS hits FROM cells UNION ALL SELECT y_pred, 0, n, 0 FROM cells),
sums AS (SELECT label, sum(support)::BIGINT AS support, sum(predicted)::BIGINT AS predicted, sum(hits)::BIGINT AS hits FROM sides GROUP BY 1),
metrics AS (SELECT label, CASE WHEN predicted = 0 THEN 0.0::DOUBLE ELSE hits::DOUBLE / predicted END AS precision, CASE WHEN support = 0 THEN 0.0::DOUBLE ELSE hits::DOUBLE / support END AS recall,
  CASE WHEN predicted + support = 0 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE * hits / (predicted + support) END AS f1, support, hits FROM sums)"""


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest centroids over embeddings as a classifier: true and predicted label, confidence, probability of the truth."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("y_true"), F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    means = rows.select("y_true", F.posexplode("e").alias("i", "x")).groupBy("y_true", "i").agg(F.round(F.avg("x"), 9).alias("m"))
    center = F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda p: p["m"])
    # One row of classes times dimensions goes to every task; each vector is scored where it is read.
    centers = means.groupBy("y_true").agg(center.alias("c")).agg(F.array_sort(F.collect_list(F.struct(F.col("y_true").alias("l"), "c"))).alias("centers"))

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, m: x * m), F.lit(0.0), lambda s, x: s + x)

    scored = rows.join(F.broadcast(centers)).withColumn("scores", F.transform("centers", lambda c: F.round(dot(F.col("e"), c["c"]), 6)))
    best = F.array_position("scores", F.array_max("scores")).cast("int")  # the first: labels are in order
    total = F.aggregate("scores", F.lit(0.0), lambda s, x: s + F.exp(x))
    own = F.array_position(F.transform("centers", lambda c: c["l"]), F.col("y_true")).cast("int")
    found = scored.withColumn("total", total).select(
        "id",
        "y_true",
        F.element_at("centers", best)["l"].alias("y_pred"),
        F.round(F.exp(F.element_at("scores", best)) / F.col("total"), 6).alias("confidence"),
        F.round(F.exp(F.element_at("scores", own)) / F.col("total"), 6).alias("p_true"),
    )
    part = F.when(F.col("id") % 10 < 8, "train").when(F.col("id") % 10 == 8, "validation").otherwise("test")
    return found.withColumn("run", (F.col("id") % 3).cast("int")).withColumn("split", part)
