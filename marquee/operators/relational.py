"""Relational operators the scenarios and the ingestion jobs share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.arrays import contains_all, contains_any, sorted_distinct
from marquee.functions.json import bracketed, document, keep_last_key, variant_contains
from marquee.session import shared_dir

# A broadcast needs a counted side; beyond this many rows the join shuffles both sides.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20

# Spark keeps only the first n rows per group before the shuffle up to this n
# (spark.sql.optimizer.windowGroupLimitThreshold); beyond it hot groups need salts.
GROUP_LIMIT_ROWS = 1000


def is_small(rows: int, size: int = 0) -> bool:
    """Whether a side of so many rows, with ``size`` bytes of text, may be broadcast."""
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def small_side(df: DataFrame) -> DataFrame:
    """``df`` (of narrow rows) hinted for broadcast if a count shows it small, else as is."""
    return F.broadcast(df) if is_small(df.count()) else df


def shuffled_side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` as the side of a join that shuffles, or as is if ``rows`` are counted and few.

    Spark judges a side by the bytes of its files. Columns that repeat make these few however
    many rows they hold, and the broadcast chosen then fails for want of memory.
    """
    return df if rows is not None and is_small(rows) else df.hint("merge")


def computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` plus ``columns``, each evaluated once per row.

    A filter on a computed column is otherwise pushed below its projection, and the whole
    expression runs again there for every use. The one-row generator keeps it above; worth
    it for parsing and conversions, not for cheap expressions.
    """
    packed = F.struct(*(column.alias(name) for name, column in columns.items()))
    return df.select("*", F.inline(F.array(packed)))


def array_any_join(
    left: DataFrame, right: DataFrame, key: str, array: str, how: str = "inner"
) -> DataFrame:
    """Join where ``left.key`` is an element of ``right.array``, as an equi-join.

    A row of ``right`` meets a key once however often its array repeats it. The membership
    predicate itself would plan a nested-loop join.
    """
    members = right.withColumn(key, F.explode(F.array_distinct(array)))
    return left.join(members, key, how)


def unordered_pairs(df: DataFrame, array: str, first: str, second: str) -> DataFrame:
    """A row per pair of distinct non-null elements of each row's array, first < second."""
    rest = [c for c in df.columns if c != array]
    firsts = df.withColumn("_all", sorted_distinct(F.col(array))).select(
        *rest, "_all", F.posexplode("_all").alias("_at", first)
    )
    later = F.slice("_all", F.col("_at") + 2, F.size("_all"))
    return firsts.select(*rest, first, F.explode(later).alias(second))


def increasing_pairs(df: DataFrame, array: str, first: str, second: str) -> DataFrame:
    """As ``unordered_pairs`` on the array as it is: repeated elements give repeated pairs."""
    rest = [c for c in df.columns if c != array]
    firsts = df.select(*rest, array, F.explode(array).alias(first))
    pairs = firsts.select(*rest, first, F.explode(array).alias(second))
    return pairs.filter(F.col(first) < F.col(second))


def top_n_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank: str = "rank",
    salt_by: Sequence[str] = (),
    salts: int = 4096,
) -> DataFrame:
    """The first ``n`` rows of each group, ranked from 1.

    Up to 1000 rows Spark cuts each group inside every map task, so a hot group reaches the
    reducer as n rows per task. Beyond that the cut runs twice, first within ``salts``
    slices of each group (chosen by ``salt_by``), so no task sorts a whole hot group.
    """
    if n < 1:
        raise ValueError("n must be positive")
    if n > GROUP_LIMIT_ROWS and salt_by:
        slice_of = F.pmod(F.xxhash64(*salt_by), F.lit(salts))
        within = Window.partitionBy(*group, "_slice").orderBy(*order)
        df = (
            df.withColumn("_slice", slice_of)
            .withColumn(rank, F.row_number().over(within))
            .filter(F.col(rank) <= n)
            .drop("_slice", rank)
        )
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col(rank) <= n)


def lowest_n(df: DataFrame, key: str, n: int, direct: int = 10_000) -> DataFrame:
    """The ``n`` rows with the smallest values of the unique, non-negative long ``key``.

    Up to ``direct`` it is a plain top-n: n rows of every task pass through one that keeps n.
    Beyond that the rows, which should be narrow, are written once, the cut-off comes from a
    histogram of key ranges, and only the one range that crosses it, at most 65536 rows, is
    ranked.
    """
    if n <= direct:
        return df.orderBy(key).limit(n)
    path = shared_dir(df.sparkSession, "keys")
    df.write.parquet(path)
    df = df.sparkSession.read.schema(df.schema).parquet(path)
    bucket = F.shiftright(F.col(key), 16)
    running = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    edge = (
        df.groupBy(bucket.alias("_range"))
        .agg(F.count("*").alias("_rows"))
        .orderBy("_range")
        .limit(n)  # no range is empty, so more are never needed
        .withColumn("_before", F.coalesce(F.sum("_rows").over(running), F.lit(0)))
        .filter(F.col("_before") < n)
        .agg(F.max("_range").alias("_range"), F.max("_before").alias("_before"))
    )
    edge_range = edge.select("_range").scalar()
    edge_before = edge.select("_before").scalar()
    whole = df.filter(bucket < edge_range)
    crossing = (
        df.filter(bucket == edge_range)
        .withColumn("_at", F.row_number().over(Window.orderBy(key)))
        .filter(F.col("_at") <= n - edge_before)
        .drop("_at")
    )
    return whole.unionByName(crossing)


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order``; the other columns break ties.

    An aggregate, not a window: repeats fold inside the map tasks, so a key holding a third
    of the rows reaches its reducer as one row per task.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("_first")
    return df.groupBy(*key).agg(first).select(
        *(F.col(c) if c in key else F.col(f"_first.{c}").alias(c) for c in df.columns)
    )


def _held(
    target: DataFrame, key: Sequence[str], batch: DataFrame, batch_key: Sequence[str], rows: int | None
) -> DataFrame:
    """Rows of ``target``, cut to the keys in ``batch`` when that is counted and small.

    The batch's keys are broadcast then, so the target is scanned without a shuffle. Where it is
    counted and large, the target is no broadcast either, however few its files' bytes.
    """
    if rows is None:
        return target
    if not is_small(rows):
        return shuffled_side(target)
    wanted = batch.select(*(F.col(b).alias(k) for b, k in zip(batch_key, key))).distinct()
    return target.join(F.broadcast(wanted), list(key), "left_semi")


def without_existing(
    batch: DataFrame, target: DataFrame, key: Sequence[str], rows: int | None = None
) -> DataFrame:
    """Rows of ``batch`` whose key ``target`` does not hold yet.

    ``rows`` is the caller's count (or bound) of the batch. A small batch leaves the target
    unshuffled; otherwise both sides shuffle their keys.
    """
    held = _held(target.select(*key), key, batch, key, rows)
    return batch.join(held, list(key), "left_anti")


def with_parent_flag(
    child: DataFrame, fk: str, parent: DataFrame, pk: str, flag: str, rows: int | None = None
) -> DataFrame:
    """``child`` plus a boolean: the reference is NULL or ``parent`` holds it (pk unique)."""
    keys = _held(parent.select(pk), [pk], child, [fk], rows)
    keys = keys.select(F.col(pk).alias("_pk"), F.lit(True).alias("_hit"))
    joined = child.join(keys, F.col(fk) == F.col("_pk"), "left")
    ok = F.col(fk).isNull() | F.col("_hit").isNotNull()
    return joined.withColumn(flag, ok).drop("_pk", "_hit")


def split_orphans(
    child: DataFrame, references: Sequence[tuple[str, DataFrame, str]], rows: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(insertable, orphans): rows whose references all exist, and the others.

    ``references`` are (column, parent, parent key); ``rows`` as in ``without_existing``.
    """
    marked = child
    flags = [f"_ref{i}" for i in range(len(references))]
    for flag, (fk, parent, pk) in zip(flags, references):
        marked = with_parent_flag(marked, fk, parent, pk, flag, rows)
    ok = F.lit(True)
    for flag in flags:
        ok = ok & F.col(flag)
    return marked.filter(ok).drop(*flags), marked.filter(~ok).drop(*flags)


def inverted_index(df: DataFrame, array: str, key: str, value: str = "value") -> DataFrame:
    """(value, key) rows, one per distinct non-null element of each row's array.

    Kept as rows: one list per value would put a third of all ids in one cell for a hot
    value. ``sources.layout.write_inverted_index`` stores it sorted for lookups.
    """
    exploded = df.select(F.explode(F.array_distinct(array)).alias(value), key)
    return exploded.filter(F.col(value).isNotNull())


def with_genres(df: DataFrame, every: Sequence[str] = (), some: Sequence[str] = (), col: str = "genres"):
    """Rows whose array contains all of ``every`` and, if given, at least one of ``some``."""
    out = df.filter(contains_all(F.col(col), every)) if every else df
    return out.filter(contains_any(F.col(col), some)) if some else out


def json_contains(df: DataFrame, col: str, pattern: dict) -> DataFrame:
    """Rows whose JSON text column contains ``pattern`` (see ``variant_contains``)."""
    keep_last_key(df.sparkSession)
    parsed = computed(df, {"_parsed": F.expr(bracketed(col))})
    docs = computed(parsed, {"_doc": F.expr(document(col, "_parsed"))})
    return docs.filter(variant_contains(F.col("_doc"), pattern)).drop("_parsed", "_doc")
