"""Session settings the jobs rely on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cores: int | str = "*", app: str = "marquee", **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark; a cluster brings its own."""
    settings = {
        "spark.sql.shuffle.partitions": "8" if cores == "*" else str(cores),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    }
    settings.update(conf)
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for ``name`` below ``spark.checkpoint.dir``, which all executors share.

    Where the setting is absent, the folder given to ``SparkContext.setCheckpointDir`` counts.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{base.rstrip('/')}/{name}-{os.urandom(6).hex()}"
