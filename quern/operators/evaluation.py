"""Evaluation of classifiers from a table of predictions: id, y_true, y_pred, confidence, and what splits it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quern.operators import ordinals

#: Probabilities are kept this far from 0 before a logarithm.
EPSILON = 1e-15


def class_index(labels: DataFrame, label: str) -> DataFrame:
    """Distinct labels in order with a dense index from 0."""
    names = labels.select(label).where(F.col(label).isNotNull()).distinct()
    return ordinals.ordered(names, label, name="class_index").select(label, F.col("class_index").cast("int").alias("class_index"))


def quantiles(rows: DataFrame, value: str, at: list[float], *by: str) -> DataFrame:
    """by, quantile and value: exact quantiles, between two values in proportion, of the values that are not null.

    A value's position in its group comes from ordinals, so no task holds a group; only the one or two values next to
    each quantile go on.
    """
    if bad := [q for q in at if not 0 <= q <= 1]:
        raise ValueError(f"quantiles outside 0 to 1: {bad}")
    known = rows.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("value"))
    placed = ordinals.within(known, list(by), "value", name="place")
    groups = placed.groupBy(*by).agg(F.count("*").alias("n"))
    asked = groups.select(*(F.col(k).alias(f"of_{k}") for k in by), F.explode(F.array(*(F.lit(float(q)) for q in at))).alias("quantile"), "n").withColumn("rank", F.col("quantile") * (F.col("n") - 1))
    wanted = asked.withColumn("place_", F.explode(F.array_distinct(F.array(F.floor("rank"), F.ceil("rank")))))
    same = F.col("place") == F.col("place_")
    for k in by:
        same = same & F.col(k).eqNullSafe(F.col(f"of_{k}"))
    near = placed.join(wanted, same).groupBy(*by, "quantile", "rank").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    return near.select(*by, "quantile", (F.col("low") + (F.col("high") - F.col("low")) * (F.col("rank") - F.floor("rank"))).alias("value"))


def confusion(predictions: DataFrame, *by: str) -> DataFrame:
    """Counts by true and predicted label, that most other tables are made from."""
    return predictions.groupBy(*by, "y_true", "y_pred").agg(F.count("*").alias("n"))


def confusion_normalized(cells: DataFrame) -> DataFrame:
    """Cells with their share of the true label's rows."""
    whole = F.sum("n").over(Window.partitionBy("y_true"))
    return cells.withColumn("share", F.round(F.col("n") / whole, 6))


def confusion_pivot(cells: DataFrame, labels: list) -> DataFrame:
    """A row a true label, a column a predicted one, zeros where nothing was counted."""
    wide = cells.groupBy("y_true").pivot("y_pred", labels).agg(F.sum("n"))
    return wide.na.fill(0).select("y_true", *(F.col(f"`{x}`").alias(f"pred_{x}") for x in labels))


def confusion_dense(cells: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """Every pair of labels with its count, 0 where none was seen; the square of the number of labels."""
    names = labels.select(F.col(label).alias("y_true")).distinct()
    pairs = names.join(F.broadcast(names.withColumnRenamed("y_true", "y_pred")))
    return pairs.join(cells, ["y_true", "y_pred"], "left").na.fill(0, ["n"])


def transposed(metrics: DataFrame, key: str, names: list[str], keys: list) -> DataFrame:
    """A row a metric, a column a key: the table on its side."""
    long = metrics.select(F.col(key), *(F.col(n).cast("double").alias(n) for n in names)).unpivot([key], names, "metric", "value")
    wide = long.groupBy("metric").pivot(key, keys).agg(F.max("value"))
    return wide.select("metric", *(F.col(f"`{k}`").alias(f"label_{k}") for k in keys))


def top_confusions(cells: DataFrame, n: int) -> DataFrame:
    """The n most frequent wrong cells (a report)."""
    return cells.where("y_true <> y_pred").orderBy(F.desc("n"), "y_true", "y_pred").limit(n)


def per_class(cells: DataFrame) -> DataFrame:
    """precision, recall, f1 and support of every label that is true or predicted; 0 where undefined."""
    sides = cells.select(F.col("y_true").alias("label"), F.col("n").alias("support"), F.lit(0).alias("predicted"), F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0).alias("hits"))
    sides = sides.unionAll(cells.select(F.col("y_pred"), F.lit(0), F.col("n"), F.lit(0)))
    found = sides.groupBy("label").agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits"))
    zero = F.lit(0.0)
    return found.select(
        "label",
        F.coalesce(F.try_divide("hits", "predicted"), zero).alias("precision"),
        F.coalesce(F.try_divide("hits", "support"), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * F.col("hits"), F.col("predicted") + F.col("support")), zero).alias("f1"),
        "support",
        "hits",
    )


def rounded(metrics: DataFrame, *names: str) -> DataFrame:
    return metrics.select(*(F.round(c, 6).alias(c) if c in names else F.col(c) for c in metrics.columns))


def averages(metrics: DataFrame) -> DataFrame:
    """accuracy, macro and weighted averages of per_class()."""
    names = ("precision", "recall", "f1")
    weight = F.sum("support")
    return metrics.agg(
        F.round(F.try_divide(F.sum("hits"), weight), 6).alias("accuracy"),
        *(F.round(F.avg(m), 6).alias(f"macro_{m}") for m in names),
        *(F.round(F.try_divide(F.sum(F.col(m) * F.col("support")), weight), 6).alias(f"weighted_{m}") for m in names),
        weight.alias("support"),
    )


def report(metrics: DataFrame) -> DataFrame:
    """Rows by label, then accuracy, macro and weighted averages, in one table."""
    one = averages(metrics)
    rows = rounded(metrics, "precision", "recall", "f1").select(F.col("label").cast("string").alias("label"), "precision", "recall", "f1", "support")
    accuracy = one.select(F.lit("accuracy").alias("label"), F.col("accuracy").alias("precision"), F.col("accuracy").alias("recall"), F.col("accuracy").alias("f1"), "support")
    both = [one.select(F.lit(f"{k} avg").alias("label"), *(F.col(f"{k}_{m}").alias(m) for m in ("precision", "recall", "f1")), "support") for k in ("macro", "weighted")]
    return rows.unionByName(accuracy).unionByName(both[0]).unionByName(both[1])


def accuracy_by(predictions: DataFrame, *by: str) -> DataFrame:
    """Share of right predictions and rows, by the given columns."""
    return predictions.groupBy(*by).agg(F.round(F.avg((F.col("y_true") == F.col("y_pred")).cast("double")), 6).alias("accuracy"), F.count("*").alias("n"))


def accuracy_by_class_and_split(predictions: DataFrame, splits: list[str]) -> DataFrame:
    """A row a label, a column a split, 0 where a split has no rows of the label."""
    right = F.col("y_true") == F.col("y_pred")
    return predictions.groupBy("y_true").agg(*(F.round(F.coalesce(F.avg(F.when(F.col("split") == s, right.cast("double"))), F.lit(0.0)), 6).alias(f"{s}_accuracy") for s in splits))


def log_loss(predictions: DataFrame, p_true: str = "p_true") -> DataFrame:
    """Mean negative logarithm of the true label's probability, kept between EPSILON and 1."""
    p = F.least(F.greatest(F.col(p_true), F.lit(EPSILON)), F.lit(1.0))
    return predictions.agg(F.round(F.avg(-F.log(p)), 6).alias("log_loss"), F.count("*").alias("n"))


def confidence_stats(predictions: DataFrame) -> DataFrame:
    """Mean, exact median, least and most; nulls without rows."""
    c = F.col("confidence")
    stats = predictions.agg(F.round(F.avg(c), 6).alias("mean"), F.round(F.min(c), 6).alias("least"), F.round(F.max(c), 6).alias("most"))
    middle = quantiles(predictions, "confidence", [0.5]).agg(F.round(F.first("value"), 4).alias("median"))  # one row
    return stats.join(F.broadcast(middle)).select("mean", "median", "least", "most")


def confidence_histogram(predictions: DataFrame, bins: int = 20) -> DataFrame:
    """Rows by equal bins of 0 to 1, the last one closed."""
    at = F.least(F.floor(F.col("confidence") * bins), F.lit(bins - 1)).cast("int")
    return predictions.groupBy(at.alias("bin")).agg(F.count("*").alias("n"))


def misclassified(predictions: DataFrame, *columns: str) -> DataFrame:
    """The wrong rows, with the given columns of their items, which travel with the prediction and are never zipped to it."""
    return predictions.where("y_true <> y_pred").select(*columns, "y_true", "y_pred", "confidence")


def top_and_bottom(metrics: DataFrame, n: int) -> DataFrame:
    """The n best and the n worst labels by f1 (a report)."""
    best = metrics.orderBy(F.desc("f1"), "label").limit(n).withColumn("side", F.lit("top"))
    worst = metrics.orderBy("f1", "label").limit(n).withColumn("side", F.lit("bottom"))
    return best.unionByName(worst)


def best_epoch(history: DataFrame, *by: str) -> DataFrame:
    """The epoch with the highest val_accuracy, the first of equals, with its loss."""
    found = history.groupBy(*by).agg(F.max(F.struct("val_accuracy", (-F.col("epoch")).alias("first"), "val_loss")).alias("b"))
    return found.select(*by, (-F.col("b.first")).alias("best_epoch"), F.col("b.val_accuracy").alias("best_val_accuracy"), F.col("b.val_loss").alias("val_loss"))


def run_summary(runs: DataFrame, *metrics: str) -> DataFrame:
    """Mean and sample deviation of metrics over repeated runs."""
    parts = [x for m in metrics for x in (F.round(F.avg(m), 6).alias(f"{m}_mean"), F.round(F.coalesce(F.stddev_samp(m), F.lit(0.0)), 6).alias(f"{m}_std"))]
    return runs.agg(F.count("*").alias("runs"), *parts)
