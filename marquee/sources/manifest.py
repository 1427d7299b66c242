"""Source manifests and per-source progress: what is new, changed, resumable or complete."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_manifest(spark: SparkSession, data_dir: str) -> DataFrame:
    """(source_file, source_size_bytes, source_mtime_ns) of the files in a folder.

    Only listing metadata is read, never file contents.
    """
    files = spark.read.format("binaryFile").load(data_dir)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("source_file"),
        F.col("length").alias("source_size_bytes"),
        (F.unix_micros("modificationTime") * 1000).alias("source_mtime_ns"),
    )


def manifest_status(manifest: DataFrame, progress: DataFrame) -> DataFrame:
    """``manifest`` plus status (new, changed, complete, resume) and the line to resume after."""
    seen = progress.select(
        "source_file",
        F.col("source_size_bytes").alias("_size"),
        F.col("source_mtime_ns").alias("_mtime"),
        "last_line",
        "completed",
    )
    same = (F.col("_size") == F.col("source_size_bytes")) & (
        F.col("_mtime") == F.col("source_mtime_ns")
    )
    status = (
        F.when(F.col("_size").isNull(), F.lit("new"))
        .when(~same, F.lit("changed"))
        .when(F.col("completed"), F.lit("complete"))
        .otherwise(F.lit("resume"))
    )
    resume_after = F.when(status == "new", F.lit(1).cast("bigint")).when(
        status == "resume", F.col("last_line")
    )
    return (
        manifest.join(seen, "source_file", "left")
        .withColumns({"status": status, "resume_after": resume_after})
        .select(*manifest.columns, "status", "resume_after")
    )


def upsert_progress(progress: DataFrame, updates: DataFrame) -> DataFrame:
    """Progress with ``updates`` replacing rows of the same source; the latest update wins."""
    both = progress.withColumn("_new", F.lit(0)).unionByName(updates.withColumn("_new", F.lit(1)))
    rest = [c for c in progress.columns if c != "source_file"]
    latest = F.max_by(F.struct(*rest), F.struct("_new", "updated_at", "last_line"))
    return both.groupBy("source_file").agg(latest.alias("_row")).select("source_file", "_row.*")


def reset_progress(progress: DataFrame, sources: Sequence[str] | DataFrame) -> DataFrame:
    """Progress without the given sources (a list of names or a source_file frame)."""
    if isinstance(sources, DataFrame):
        return progress.join(sources.select("source_file"), "source_file", "left_anti")
    return progress.filter(~F.col("source_file").isin(*sources))
