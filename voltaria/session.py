"""A Spark session with the settings that the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "voltaria", **conf: str) -> SparkSession:
    """UTC and ANSI semantics, adaptive execution. Cluster settings stay what the submitter gave."""
    b = SparkSession.builder.appName(app)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}
    for k, v in (settings | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()
