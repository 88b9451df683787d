"""Session settings the marts rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Results depend on these two: one clock and checked arithmetic.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Only speed depends on these. A skewed join is split even where that costs one more shuffle.
SPEED_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def local_session(cores: int | str = "*", memory: str = "8g", **extra: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("martwright")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {**RESULT_SETTINGS, **SPEED_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the settings on a session somebody else made."""
    for key, value in {**RESULT_SETTINGS, **SPEED_SETTINGS}.items():
        spark.conf.set(key, value)
    return spark
