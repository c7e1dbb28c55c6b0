"""A session with the settings the operators are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "quern", master: str | None = None, **conf: str) -> SparkSession:
    """Adaptive plans, UTC, Arrow; conf overrides by key with double underscores for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | {k.replace("__", "."): str(v) for k, v in conf.items()}
    return builder.config(map=settings).getOrCreate()
