"""Spark session used by the tests, the bench and stand-alone runs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_spark(app: str = "finmarts", master: str | None = None, **conf: str) -> SparkSession:
    """A session with AQE, skew-join splitting and UTC dates; on a cluster pass no master."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
