"""Session defaults for tests and local runs; a cluster keeps its own settings."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, partitions: int | None = None, app: str = "ledgerline") -> SparkSession:
    n = str(partitions or cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("LEDGERLINE_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", n)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # call-site capture costs about a millisecond per column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
