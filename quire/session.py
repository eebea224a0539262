"""Session settings that every entry point shares."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: str = "8", app: str = "quire", **extra: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; a cluster brings its own."""
    conf = {
        "spark.master": f"local[{cores}]",
        "spark.driver.memory": os.environ.get("QUIRE_DRIVER_MEMORY", "12g"),
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.files.maxPartitionBytes": "4m",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": "/tmp/quire-checkpoints",
    } | extra
    spark = SparkSession.builder.appName(app).config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
