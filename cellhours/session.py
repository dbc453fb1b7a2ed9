"""A Spark session with the settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Quantile buffers are small value counts, so hashing beats sorting far beyond 128 groups.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "16384",
    # Streaming state lives on disk with incremental checkpoints, not in the JVM heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # The files of an exchange go with the query that wrote them, not with the driver's next
    # garbage collection.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Counting the stored rows would look every key up again at each write and each removal.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}

# Only at session start. Recording the Python call site of every column costs more than
# building the plan does.
START_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the run-time SQL settings on an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cellhours")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in {**SETTINGS, **START_SETTINGS}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
