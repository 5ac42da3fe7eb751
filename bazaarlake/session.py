"""Session settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings a job of this library expects. All are runtime-mutable SQL settings, and AQE
# picks the number of reduce partitions from data sizes, so no partition count is fixed.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Measured bytes of a joined side, known before the other side is shuffled, unlike the estimates that plans start from.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
}


def local_session(app: str = "bazaarlake", cpus: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # Call-site capture costs several driver round trips for each column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark
