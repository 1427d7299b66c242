"""Reading the raw dumps: tab-separated text with a header line, plain or gzipped.

Lines are split by hand rather than by the CSV reader because an empty field is a value here
(only ``\\N`` is null), short rows are allowed and quotes mean nothing.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.operators.relational import lowest_n, small_side
from marquee.schemas import DATASETS, Dataset
from marquee.session import shared_dir

log = logging.getLogger("marquee")

_IN_PARTITION = (1 << 33) - 1  # low bits of monotonically_increasing_id


def select_sources(
    available: Sequence[str], selectors: Sequence[str] = (), prefer_plain: bool = False
) -> list[tuple[Dataset, str]]:
    """(dataset, file name) pairs to load, in load order.

    Where both exist the gzip file is taken, or with ``prefer_plain`` the plain one, which
    many tasks can read at once. ``selectors`` are table names or file names (either
    spelling); an unknown one raises, a missing file is logged and skipped.
    """
    known = {
        name: dataset
        for dataset in DATASETS.values()
        for name in (dataset.table, dataset.filename, dataset.plain_filename)
    }
    unknown = sorted(set(selectors) - set(known))
    if unknown:
        raise ValueError(f"unknown file/table selectors: {', '.join(unknown)}")
    wanted = {known[name].table for name in selectors} or set(DATASETS)
    chosen = []
    for dataset in DATASETS.values():
        if dataset.table not in wanted:
            continue
        present = [n for n in (dataset.filename, dataset.plain_filename) if n in available]
        if present:
            chosen.append((dataset, present[-1 if prefer_plain else 0]))
        else:
            log.warning("dataset file is missing: %s", dataset.filename)
    return chosen


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names in the first line of the file."""
    first = spark.read.text(path).head(1)
    return first[0].value.split("\t") if first else []


def check_header(header: Sequence[str], dataset: Dataset, name: str) -> dict[str, int]:
    """Position of each declared column; extra columns are allowed, missing ones raise."""
    missing = sorted({f.source for f in dataset.fields} - set(header))
    if missing:
        raise ValueError(f"{name} is missing headers: {', '.join(missing)}")
    return {column: at for at, column in enumerate(header)}


def source_columns(line: Column, positions: dict[str, int], dataset: Dataset) -> list[Column]:
    """The declared source columns of one line; fields a short line lacks are NULL."""
    parts = F.split(line, "\t", -1)
    return [F.get(parts, F.lit(positions[f.source])).alias(f.source) for f in dataset.fields]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.text(path)
        .select(
            F.col("_metadata.file_name").alias("source_file"),
            F.col("_metadata.file_block_start").alias("_split"),
            "value",
        )
        .filter(F.col("value") != "")
    )


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, source_line, value): non-blank lines numbered from 1 within the file.

    A gzip file is one task, so a line's number is its index there. A plain file is read in
    splits: their line counts, one row per split, give each split its offset, at the price
    of reading the file twice.
    """
    at = _lines(spark, path).withColumn("_at", F.monotonically_increasing_id())
    if path.endswith(".gz"):
        line = F.col("_at").bitwiseAND(_IN_PARTITION) + 1
        return at.select("source_file", line.alias("source_line"), "value")
    earlier = (
        Window.partitionBy("source_file")
        .orderBy("_split")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    splits = (
        at.groupBy("source_file", "_split")
        .agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .drop("_rows")
    )
    # One row per split, written so that counting and joining it do not read the file again.
    written = shared_dir(spark, "splits")
    splits.write.parquet(written)
    splits = spark.read.schema(splits.schema).parquet(written)
    line = F.col("_offset") + F.col("_at") - F.col("_first") + 1
    return at.join(small_side(splits), ["source_file", "_split"]).select(
        "source_file", line.alias("source_line"), "value"
    )


def read_tsv(
    spark: SparkSession, path: str, dataset: Dataset, partitions: int | None = None
) -> DataFrame:
    """One dump file as (source_file, source_line, the declared source columns as text).

    The header is line 1. A gzip file arrives as one task and is spread, over ``partitions`` or
    as its size suggests, before the columns are parsed.
    """
    positions = check_header(header_of(spark, path), dataset, path.rsplit("/", 1)[-1])
    lines = numbered_lines(spark, path).filter(F.col("source_line") > 1)
    if partitions:
        lines = lines.repartition(partitions, "source_line")
    elif path.endswith(".gz"):
        lines = lines.repartition("source_line")
    return lines.select(
        "source_file", "source_line", *source_columns(F.col("value"), positions, dataset)
    )


def up_to_accepted(classified: DataFrame, max_rows: int, line: str = "source_line") -> DataFrame:
    """``classified`` up to the line of its ``max_rows``-th accepted row (0: all of it).

    Rows refused before that line are kept, so their dead letters are too.
    """
    if max_rows <= 0:
        return classified
    good = classified.filter(F.col("reason").isNull()).select(line)
    last = lowest_n(good, line, max_rows).agg(F.max(line).alias("last"), F.count("*").alias("n"))
    # Fewer accepted rows than the cap: the whole file counts as read.
    reached = last.select(F.when(F.col("n") >= max_rows, F.col("last")))
    return classified.filter(F.coalesce(F.col(line) <= reached.scalar(), F.lit(True)))
