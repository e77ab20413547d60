"""A session with the settings the jobs are written for."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # State that outgrows executor memory lives on local disk and is
    # restored from the checkpoint folder when an executor is lost.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra) -> SparkSession:
    """Session for tests and benchmarks on one machine.

    Working tables go to a new temporary folder unless ``extra`` names one.
    """
    if "spark.checkpoint.dir" not in extra:
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="brooklog-")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("brooklog")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
    )
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
