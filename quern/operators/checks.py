"""Assertions over tables: totals, snapshots before and after a step, and a gate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class CheckFailed(AssertionError):
    """A table is not what a step requires."""


def totals(actual: DataFrame, expected: dict[str, int]) -> DataFrame:
    """label, expected, actual, status (PASS or FAIL) of the numbers in the one row of actual."""
    wide = actual.select(*(F.col(k).cast("long").alias(k) for k in expected))
    long = wide.unpivot([], list(expected), "label", "actual")
    wanted = F.create_map(*(x for k, v in expected.items() for x in (F.lit(k), F.lit(v).cast("long"))))
    rows = long.withColumn("expected", F.element_at(wanted, F.col("label")))
    return rows.select("label", "expected", "actual", F.when(F.col("actual").eqNullSafe(F.col("expected")), "PASS").otherwise("FAIL").alias("status"))


def require_totals(actual: DataFrame, expected: dict[str, int]) -> None:
    """Raises CheckFailed unless every number is as expected."""
    if bad := totals(actual, expected).where("status = 'FAIL'").collect():
        raise CheckFailed("; ".join(f"{r.label}: {r.actual}, not {r.expected}" for r in bad))


def snapshot_changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Rows by key in two snapshots and whether a step left their number as it was."""
    sides = before.groupBy(key).agg(F.count("*").alias("before")).join(after.groupBy(key).agg(F.count("*").alias("after")), key, "full")
    return sides.select(key, F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("after", F.lit(0)).alias("after")).withColumn("unchanged", F.col("before") == F.col("after"))


def require_approval(approved: bool, step: str) -> None:
    """Stops a step that someone has to allow first."""
    if not approved:
        raise CheckFailed(f"{step} needs approval: pass approved=True once its input has been looked at")
