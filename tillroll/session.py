"""Session settings that the results depend on, and sensible defaults around them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", **settings: str) -> SparkSession:
    """Local session for tests and benchmarks. A cluster brings its own settings."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tillroll")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
