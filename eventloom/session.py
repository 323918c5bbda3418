"""Session settings: a local session for tests and the settings a cluster job needs."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Worth setting on any cluster. Sizes and counts of partitions are left to AQE.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cpus: str | int = "*", memory: str = "8g") -> SparkSession:
    """A session in this process, with one shuffle partition per core."""
    partitions = "8" if str(cpus) == "*" else str(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("eventloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
