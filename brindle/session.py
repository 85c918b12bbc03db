"""Session settings for tests, the bench and clusters."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution does the sizing: start from many shuffle partitions, merge
# small ones up to the advisory size, split the skewed ones in joins.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # stream state on local disk and in the checkpoint, not on the heap
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # do not look up the Python call site for every Column expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def cluster_builder(app: str, shuffle_partitions: int = 8000) -> SparkSession.Builder:
    """Builder for spark-submit; master and memory come from the command line."""
    builder = SparkSession.builder.appName(app).config(
        "spark.sql.shuffle.partitions", str(shuffle_partitions)
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def local_session(app: str, cpus: int | str = "*", memory: str = "8g") -> SparkSession:
    """Single-machine session for tests and the bench, bound to loopback."""
    partitions = 8 if cpus == "*" else int(cpus)
    spark = (
        cluster_builder(app, partitions)
        .master(f"local[{cpus}]")
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
