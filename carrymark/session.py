"""Session settings the jobs are designed for.

A cluster job normally receives its session from the platform; these settings
are what the plans expect from it. Nothing in the library changes a session.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    # Fact-to-dimension joins may meet one instrument, fund or company that
    # owns a large share of all rows; AQE splits such partitions at run time.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Joins whose build side turns out to fit per partition hash instead of
    # sorting the fact; AQE checks the measured sizes first.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


def local_session(app: str, cores: int | str = "*", shuffle_partitions: int = 8,
                  memory: str = "8g", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks, with the web page off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
