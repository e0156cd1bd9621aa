"""The Spark session used by tests, the bench and the command line."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from .storage import ship


def get_spark(app: str = "docweft", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine expects; a running session is reused."""
    builder = SparkSession.builder.appName(app)
    if master or "MASTER" not in os.environ:
        builder = builder.master(master or "local[*]")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    return spark
