"""Queries over predictions: confusion, metrics, confidence, errors and repeated runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import scalars
from quern.operators import evaluation as ev
from quern.plans import surrogates as s
from quern.plans.registry import register
from quern.sources.tables import table

P = f"WITH {s.PREDICTIONS_SQL}\n"
LABELS = list(range(10))


def cells(spark: SparkSession, d: str) -> DataFrame:
    return ev.confusion(s.predictions(spark, d))


@register("class_index", "SELECT lang, (dense_rank() OVER (ORDER BY lang) - 1)::INTEGER AS class_index FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL)")
def class_index(spark: SparkSession, d: str) -> DataFrame:
    return ev.class_index(table(spark, d, "documents"), "lang")


@register("predictions", P + "SELECT id, y_true, y_pred, confidence, p_true, run, split FROM predictions")
def predictions(spark: SparkSession, d: str) -> DataFrame:
    return s.predictions(spark, d)


@register("confusion_long", P + "SELECT * FROM cells")
def confusion_long(spark: SparkSession, d: str) -> DataFrame:
    return cells(spark, d)


@register("confusion_normalized", P + "SELECT *, round(n / sum(n) OVER (PARTITION BY y_true), 6) AS share FROM cells")
def confusion_normalized(spark: SparkSession, d: str) -> DataFrame:
    return ev.confusion_normalized(cells(spark, d))


@register("confusion_pivot", P + "SELECT y_true, " + ", ".join(f"coalesce(sum(n) FILTER (y_pred = {i}), 0)::BIGINT AS pred_{i}" for i in LABELS) + " FROM cells GROUP BY 1")
def confusion_pivot(spark: SparkSession, d: str) -> DataFrame:
    return ev.confusion_pivot(cells(spark, d), LABELS)


@register(
    "confusion_dense",
    P + "SELECT a.label AS y_true, b.label AS y_pred, coalesce(c.n, 0)::BIGINT AS n FROM (SELECT DISTINCT label FROM embeddings) a CROSS JOIN (SELECT DISTINCT label FROM embeddings) b LEFT JOIN cells c ON c.y_true = a.label AND c.y_pred = b.label",
)
def confusion_dense(spark: SparkSession, d: str) -> DataFrame:
    return ev.confusion_dense(cells(spark, d), table(spark, d, "embeddings"), "label")


TRANSPOSED = ", ".join(f"max(v) FILTER (label = {i}) AS label_{i}" for i in LABELS)


@register(
    "metrics_transposed",
    P
    + f", l AS (SELECT label, 'precision' AS metric, round(precision, 6) AS v FROM metrics UNION ALL SELECT label, 'recall', round(recall, 6) FROM metrics UNION ALL SELECT label, 'support', support::DOUBLE FROM metrics) SELECT metric, {TRANSPOSED} FROM l GROUP BY 1",
)
def metrics_transposed(spark: SparkSession, d: str) -> DataFrame:
    metrics = ev.rounded(ev.per_class(cells(spark, d)), "precision", "recall")
    return ev.transposed(metrics, "label", ["precision", "recall", "support"], LABELS)


@register("top_confusions", P + "SELECT * FROM cells WHERE y_true <> y_pred ORDER BY n DESC, y_true, y_pred LIMIT 15")
def top_confusions(spark: SparkSession, d: str) -> DataFrame:
    return ev.top_confusions(cells(spark, d), 15)


@register("per_class_metrics", P + "SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support, hits FROM metrics")
def per_class_metrics(spark: SparkSession, d: str) -> DataFrame:
    return ev.rounded(ev.per_class(cells(spark, d)), "precision", "recall", "f1")


AVERAGES = "round(sum(hits)::DOUBLE / sum(support), 6) AS accuracy, " + ", ".join(
    f"round(avg({m}), 6) AS macro_{m}, round(sum({m} * support) / sum(support), 6) AS weighted_{m}" for m in ("precision", "recall", "f1")
)


@register("macro_weighted", P + f"SELECT {AVERAGES}, sum(support)::BIGINT AS support FROM metrics")
def macro_weighted(spark: SparkSession, d: str) -> DataFrame:
    return ev.averages(ev.per_class(cells(spark, d)))


@register(
    "classification_report",
    P
    + f""", a AS (SELECT {AVERAGES}, sum(support)::BIGINT AS support FROM metrics)
    SELECT label::VARCHAR AS label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM metrics UNION ALL SELECT 'accuracy', accuracy, accuracy, accuracy, support FROM a
    UNION ALL SELECT 'macro avg', macro_precision, macro_recall, macro_f1, support FROM a UNION ALL SELECT 'weighted avg', weighted_precision, weighted_recall, weighted_f1, support FROM a""",
)
def classification_report(spark: SparkSession, d: str) -> DataFrame:
    return ev.report(ev.per_class(cells(spark, d)))


@register("accuracy_by_split", P + "SELECT split, round(avg((y_true = y_pred)::INTEGER), 6) AS accuracy, count(*) AS n FROM predictions GROUP BY 1")
def accuracy_by_split(spark: SparkSession, d: str) -> DataFrame:
    return ev.accuracy_by(s.predictions(spark, d), "split")


@register(
    "accuracy_by_class_and_split",
    P + "SELECT y_true, " + ", ".join(f"round(coalesce(avg((y_true = y_pred)::INTEGER) FILTER (split = '{x}'), 0), 6) AS {x}_accuracy" for x in ("train", "validation", "test")) + " FROM predictions GROUP BY 1",
)
def accuracy_by_class_and_split(spark: SparkSession, d: str) -> DataFrame:
    return ev.accuracy_by_class_and_split(s.predictions(spark, d), ["train", "validation", "test"])


@register("log_loss", P + "SELECT round(avg(-ln(least(greatest(p_true, 1e-15), 1.0))), 6) AS log_loss, count(*) AS n FROM predictions")
def log_loss(spark: SparkSession, d: str) -> DataFrame:
    return ev.log_loss(s.predictions(spark, d))


@register("confidence_stats", P + "SELECT round(avg(confidence), 6) AS mean, round(median(confidence), 4) AS median, round(min(confidence), 6) AS least, round(max(confidence), 6) AS most FROM predictions")
def confidence_stats(spark: SparkSession, d: str) -> DataFrame:
    return ev.confidence_stats(s.predictions(spark, d))


@register("confidence_histogram", P + "SELECT least(floor(confidence * 20), 19)::INTEGER AS bin, count(*) AS n FROM predictions GROUP BY 1")
def confidence_histogram(spark: SparkSession, d: str) -> DataFrame:
    return ev.confidence_histogram(s.predictions(spark, d))


@register("misclassified", P + "SELECT id, y_true, y_pred, confidence FROM predictions WHERE y_true <> y_pred")
def misclassified(spark: SparkSession, d: str) -> DataFrame:
    return ev.misclassified(s.predictions(spark, d), "id")


@register("first_16_errors", P + "SELECT id, y_true, y_pred, confidence FROM predictions WHERE y_true <> y_pred ORDER BY id LIMIT 16")
def first_16_errors(spark: SparkSession, d: str) -> DataFrame:
    return ev.misclassified(s.predictions(spark, d), "id").orderBy("id").limit(16)


@register(
    "top_bottom_classes",
    P
    + """, m AS (SELECT label, round(f1, 6) AS f1 FROM metrics) SELECT * FROM (SELECT label, f1, 'top' AS side FROM m ORDER BY f1 DESC, label LIMIT 3)
    UNION ALL SELECT * FROM (SELECT label, f1, 'bottom' AS side FROM m ORDER BY f1, label LIMIT 3)""",
)
def top_bottom_classes(spark: SparkSession, d: str) -> DataFrame:
    return ev.top_and_bottom(ev.rounded(ev.per_class(cells(spark, d)), "f1").select("label", "f1"), 3)


RUNS = "runs AS (SELECT run, round(avg((y_true = y_pred)::INTEGER), 6) AS accuracy, round(avg(confidence), 6) AS confidence FROM predictions GROUP BY 1)"


@register(
    "run_summary",
    P
    + f""", {RUNS} SELECT count(*) AS runs, round(avg(accuracy), 6) AS accuracy_mean, round(coalesce(stddev_samp(accuracy), 0), 6) AS accuracy_std, round(avg(confidence), 6) AS confidence_mean,
    round(coalesce(stddev_samp(confidence), 0), 6) AS confidence_std FROM runs""",
)
def run_summary(spark: SparkSession, d: str) -> DataFrame:
    runs = s.predictions(spark, d).groupBy("run").agg(F.round(F.avg((F.col("y_true") == F.col("y_pred")).cast("double")), 6).alias("accuracy"), F.round(F.avg("confidence"), 6).alias("confidence"))
    return ev.run_summary(runs, "accuracy", "confidence")


@register(
    "best_epoch",
    """WITH h AS (SELECT user_id % 5 AS run, date_part('hour', ts)::INTEGER AS epoch, round(avg(value), 2) AS val_accuracy, round(max(value), 4) AS val_loss FROM events GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY val_accuracy DESC, epoch) AS k FROM h) SELECT run, epoch AS best_epoch, val_accuracy AS best_val_accuracy, val_loss FROM r WHERE k = 1""",
)
def best_epoch(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    history = events.groupBy((F.col("user_id") % 5).alias("run"), F.hour("ts").alias("epoch")).agg(F.round(F.avg("value"), 2).alias("val_accuracy"), F.round(F.max("value"), 4).alias("val_loss"))
    return ev.best_epoch(history, "run")


@register(
    "quality_confusion",
    """SELECT l.quality AS y_true, CASE WHEN d.n_chars >= 400 THEN 1 ELSE 0 END AS y_pred, count(*) AS n FROM labels l JOIN documents d USING (doc_id) GROUP BY 1, 2""",
)
def quality_confusion(spark: SparkSession, d: str) -> DataFrame:
    judged = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    return ev.confusion(judged.select(F.col("quality").alias("y_true"), F.when(F.col("n_chars") >= 400, 1).otherwise(0).alias("y_pred")))


@register(
    "class_result_table",
    P
    + """SELECT m.label::VARCHAR AS label, round(m.precision, 6) AS precision, round(m.recall, 6) AS recall, round(m.f1, 6) AS f1, m.support, a.train_accuracy, a.validation_accuracy, a.test_accuracy FROM metrics m
    LEFT JOIN (SELECT y_true, """
    + ", ".join(f"round(coalesce(avg((y_true = y_pred)::INTEGER) FILTER (split = '{x}'), 0), 6) AS {x}_accuracy" for x in ("train", "validation", "test"))
    + " FROM predictions GROUP BY 1) a ON a.y_true = m.label",
)
def class_result_table(spark: SparkSession, d: str) -> DataFrame:
    """Each class's report row with its accuracies by split."""
    rows = s.predictions(spark, d)
    report = ev.report(ev.per_class(ev.confusion(rows)))
    accuracies = ev.accuracy_by_class_and_split(rows, ["train", "validation", "test"])
    labels = accuracies.withColumn("label", F.col("y_true").cast("string")).drop("y_true")
    classes = report.where(~F.col("label").isin("accuracy", "macro avg", "weighted avg"))
    return classes.join(F.broadcast(labels), "label", "left").select("label", "precision", "recall", "f1", "support", "train_accuracy", "validation_accuracy", "test_accuracy")


@register("embedding_argmax", "SELECT vec_id AS id, (list_position(embedding, list_max(embedding)) - 1)::INTEGER AS place FROM embeddings")
def embedding_argmax(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), scalars.argmax(F.col("embedding")).alias("place"))
