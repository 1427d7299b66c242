"""Rows of stored tables dealt into buckets by their key, so that a batch reads few of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.sources.store import Store

#: Buckets of a new store. A batch of n keys reads at most n of them, so the more there are the
#: less a small batch reads; a store keeps the number it began with.
BUCKETS = 64
ROWS_PER_FILE = 4_000_000
LAYOUT = "buckets INT"


def buckets(store: Store) -> int:
    """How many buckets the tables of a store have, recorded with the first use."""
    layout, version = store.snapshot("layout", LAYOUT)
    if version:
        return layout.head().buckets
    store.write_snapshot(store.spark.createDataFrame([(BUCKETS,)], LAYOUT).coalesce(1), "layout", 1)
    return BUCKETS


def bucket_of(key: Sequence[str], count: int) -> Column:
    """The bucket of a row by the columns of its key; a reference falls where its parent does."""
    return F.pmod(F.xxhash64(*key), F.lit(count)).cast("int")


def touched_buckets(
    batch: DataFrame, key: Sequence[str], count: int, rows: int
) -> list[int] | None:
    """The buckets of the batch's keys, at most ``count`` numbers; None stands for all.

    A batch that is likely to touch every bucket is not asked.
    """
    if rows > 4 * count:
        return None
    found = batch.dropna(subset=list(key)).select(bucket_of(key, count).alias("bucket"))
    return sorted(row.bucket for row in found.distinct().collect())


def spread(df: DataFrame, place: Sequence[str], key: Sequence[str], rows: float) -> DataFrame:
    """``df`` brought together by ``place`` (of about ``rows`` rows each) for writing.

    A place of many rows is written by several tasks, each a range of hashes of the key.
    """
    slices = int(rows // ROWS_PER_FILE) + 1
    slice_of = F.pmod(F.xxhash64(F.lit(slices), *key), F.lit(slices))
    return df.repartition(*place, slice_of).sortWithinPartitions(*place, *key)
