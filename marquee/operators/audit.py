"""Constraint audits and column statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.schemas import STATUSES


def queue_checks() -> dict[str, Column]:
    """The message table's CHECK rules."""
    return {
        "message_queue_status": F.col("status").isin(*STATUSES),
        "message_queue_attempt_count": F.col("attempt_count") >= 0,
        "message_queue_max_attempts": F.col("max_attempts") > 0,
        "message_queue_attempt_limit": F.col("attempt_count") <= F.col("max_attempts"),
    }


def _shown(columns: Sequence[str]) -> Column:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns]
    return F.concat_ws("|", *parts)


def check_violations(df: DataFrame, key: Sequence[str], checks: dict[str, Column]) -> DataFrame:
    """(constraint, key, violations) for rows failing a check; all checks in one pass."""
    broken = F.array_compact(F.array(*(F.when(~ok, F.lit(name)) for name, ok in checks.items())))
    return df.select(F.explode(broken).alias("constraint"), _shown(key).alias("key")).select(
        "constraint", "key", F.lit(1).cast("bigint").alias("violations")
    )


def duplicate_keys(df: DataFrame, key: Sequence[str], constraint: str) -> DataFrame:
    """(constraint, key, violations): keys held by more than one row. NULL parts never clash."""
    whole = df.dropna(subset=list(key))
    counts = whole.groupBy(*key).agg(F.count("*").alias("violations"))
    return counts.filter(F.col("violations") > 1).select(
        F.lit(constraint).alias("constraint"), _shown(key).alias("key"), "violations"
    )


KEPT = "bucket INT, constraint STRING, key STRING, violations BIGINT"


def bucket_duplicates(df: DataFrame, key: Sequence[str], constraint: str) -> DataFrame:
    """``duplicate_keys`` (KEPT) of a table with a ``bucket`` that its key decides.

    What one bucket violates hangs on no other bucket, so this can be kept and renewed by bucket.
    """
    whole = df.dropna(subset=list(key))
    counts = whole.groupBy("bucket", *key).agg(F.count("*").alias("violations"))
    return counts.filter(F.col("violations") > 1).select(
        "bucket", F.lit(constraint).alias("constraint"), _shown(key).alias("key"), "violations"
    )


def renewed_duplicates(
    kept: DataFrame, table: DataFrame, touched: Sequence[int] | None, key: Sequence[str], constraint: str
) -> DataFrame:
    """Duplicates (KEPT) after a batch: those kept, with the ``touched`` buckets grouped again.

    ``table`` is stored by bucket and holds the batch already; only the folders of the touched
    buckets are read. None stands for all of them.
    """
    if touched is None:
        return bucket_duplicates(table, key, constraint)
    again = bucket_duplicates(table.filter(F.col("bucket").isin(*touched)), key, constraint)
    return kept.filter(~F.col("bucket").isin(*touched)).unionByName(again)


def constraint_audit(audits: Sequence[DataFrame]) -> DataFrame:
    """All violations of several audits as one frame."""
    out = audits[0]
    for audit in audits[1:]:
        out = out.unionByName(audit)
    return out


def column_stats(df: DataFrame, exact: bool = False) -> DataFrame:
    """One row per column: rows, nulls, distinct values, smallest and largest as text.

    One pass with sketched distinct counts. ``exact`` counts them by regrouping
    (column, value) pairs, which fold in the map tasks first; that is a full shuffle of the
    distinct values, so keep it for columns that matter.
    """
    per_column = [
        F.struct(
            F.lit(c).alias("column"),
            F.count("*").alias("rows"),
            F.count_if(F.col(c).isNull()).alias("nulls"),
            F.approx_count_distinct(c).alias("distinct_values"),
            F.min(c).cast("string").alias("smallest"),
            F.max(c).cast("string").alias("largest"),
        )
        for c in df.columns
    ]
    stats = df.agg(F.array(*per_column).alias("stats")).select(F.inline("stats"))
    if not exact:
        return stats
    pairs = F.array(
        *(
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
            for c in df.columns
        )
    )
    distinct = (
        df.select(F.inline(pairs))
        .distinct()
        .groupBy("column")
        .agg(F.count("value").alias("distinct_values"))
    )
    return stats.drop("distinct_values").join(distinct, "column").select(*stats.columns)


def batch_stats(df: DataFrame, *by: str) -> DataFrame:
    """Statistics of a batch that can be merged with those of other batches: one row (for each ``by``).

    A column ``c`` of ``df`` becomes a struct: rows, nulls, smallest, largest, and a sketch of its
    distinct values (of at most some kB, whatever the batch). Column types are kept, so that the
    smallest of the smallest is the table's.
    """
    structs = [
        F.struct(
            F.count("*").alias("rows"),
            F.count_if(F.col(c).isNull()).alias("nulls"),
            F.min(c).alias("smallest"),
            F.max(c).alias("largest"),
            F.hll_sketch_agg(F.col(c).cast("string"), F.lit(SKETCH_BITS)).alias("sketch"),
        ).alias(c)
        for c in df.columns
        if c not in by
    ]
    return df.groupBy(*by).agg(*structs)


#: 2^12 registers: distinct counts are within about 1.6 percent, one standard error.
SKETCH_BITS = 12


def merged_stats(stats: DataFrame, *by: str) -> DataFrame:
    """``column_stats`` of all batches together from their ``batch_stats`` rows alone."""
    columns = [c for c in stats.columns if c not in by]
    merged = [
        F.struct(
            F.lit(c).alias("column"),
            F.sum(f"{c}.rows").alias("rows"),
            F.sum(f"{c}.nulls").alias("nulls"),
            F.hll_sketch_estimate(F.hll_union_agg(f"{c}.sketch")).alias("distinct_values"),
            F.min(f"{c}.smallest").cast("string").alias("smallest"),
            F.max(f"{c}.largest").cast("string").alias("largest"),
        )
        for c in columns
    ]
    return stats.agg(F.array(*merged).alias("stats")).select(F.inline("stats"))
