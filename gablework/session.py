"""Session defaults for local runs; on a cluster the submit-time settings win."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(app: str, cpus: int | None = None) -> SparkSession:
    cpus = cpus or os.cpu_count() or 1
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
