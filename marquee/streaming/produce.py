"""Watching a folder for new dumps."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marquee.plans.ingest import produce
from marquee.schemas import DATASETS

_FILE = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def run_produce(
    spark: SparkSession,
    data_dir: str,
    store_dir: str,
    checkpoint: str,
    wait: Callable[[], None] = lambda: time.sleep(5),
    **options: Any,
) -> StreamingQuery:
    """Queue the messages of dumps that arrived since the last run, then stop.

    The stream carries file names only, one dump per batch; ``produce`` (which takes
    ``options``) reads the file and skips what its progress says is done, so a repeated
    batch adds nothing. With ``marks`` a batch lasts until its dump is queued, and calls ``wait``
    while production is paused; the consumer is another job.
    """
    names = {n: d.table for d in DATASETS.values() for n in (d.filename, d.plain_filename)}

    def each(batch: DataFrame, _: int) -> None:
        name = F.element_at(F.split("path", "/"), -1).alias("name")
        arrived = [r.name for r in batch.select(name).collect()]  # maxFilesPerTrigger rows
        tables = [names[n] for n in arrived if n in names]
        if tables:
            now = datetime.now(timezone.utc)
            produce(spark, data_dir, store_dir, now, tables, wait=wait, **options)

    files = spark.readStream.format("binaryFile").schema(_FILE).option("maxFilesPerTrigger", 1)
    return (
        files.load(data_dir)
        .select("path")
        .writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
