"""Session with the settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tarmac.plans.shipping import ship_package


def build_session(app: str = "tarmac", master: str | None = None, **conf: str) -> SparkSession:
    """Start (or reuse) a session. Cluster settings given by the launcher win over these defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark
