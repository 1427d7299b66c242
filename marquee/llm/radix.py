"""Exact copies by splitting documents on successive bytes, most significant first."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import lower_ascii, written


def normalised(text: str = "text") -> Column:
    """What copies agree in: the text with A-Z in lower case, a null text as an empty one."""
    return lower_ascii(F.coalesce(F.col(text), F.lit("")))


def exact_copies(
    docs: DataFrame,
    carry: Mapping[str, Column] | None = None,
    first_bytes: int = 32,
    growth: int = 8,
) -> DataFrame:
    """(doc_id, the columns of ``carry``, keep_id, group_size, kept) for every row.

    Rows whose ``normalised`` texts are the same bytes are one group. ``keep_id`` is its largest
    doc_id, and one row of that doc_id is ``kept``.

    A round deals the rows of each bucket into smaller ones by their next bytes: ``first_bytes``
    in the first round, ``growth`` times as many in each later one, so that rounds grow with the
    logarithm of the longest copied beginning. Rows alone in their bucket are done, and so are
    those whose text ended: all its bytes were then compared, no digest stands for them. Only the
    others go on, with the bytes that are left. Buckets are counted with partial sums in the map
    tasks, so a bucket of a third of all rows is one row a task there; the rows then meet the
    shared buckets in a merge join, of which adaptive execution splits hot keys. It is asked for
    at every size, as the number of shared buckets grows with the documents.

    Null doc_ids are smaller than any other; a group of them has a null ``keep_id``. Of rows
    with equal doc_id and text one is ``kept``; ``group_size`` counts every row. An empty table
    gives no rows. Columns that ``carry`` does not name are ignored.
    """
    carry = dict(carry or {})
    own = F.struct(F.col("doc_id").alias("doc_id"), *(c.alias(n) for n, c in carry.items()))
    active = docs.select(
        own.alias("own"), F.lit(0).cast("long").alias("bucket"), normalised().cast("binary").alias("rest")
    )
    rounds, width = [], first_bytes
    while True:
        dealt = active.withColumn("digit", F.expr(f"substring(rest, 1, {width})"))
        buckets = (
            dealt.groupBy("bucket", "digit")
            .agg(F.count("*").alias("n"), F.max("own.doc_id").alias("last"))
            .filter("n > 1")
        )
        buckets = written(buckets.withColumn("next", F.monotonically_increasing_id()), "buckets")
        whole = F.octet_length("digit") == width
        going_on = not buckets.filter(whole).isEmpty()
        alone = F.col("next").isNull()
        ended = ~alone & ~whole
        dealt = dealt.join(buckets.hint("merge"), ["bucket", "digit"], "left").select(
            "own",
            "next",
            F.monotonically_increasing_id().alias("row"),
            F.when(~alone & whole, F.expr(f"substring(rest, {width + 1})")).alias("rest"),
            F.when(ended, F.col("last")).otherwise(F.col("own.doc_id")).alias("keep_id"),
            F.when(ended, F.col("n")).otherwise(1).alias("group_size"),
        )
        dealt = written(dealt, "dealt", compression="zstd")
        rounds.append(dealt.filter("rest IS NULL").drop("rest"))
        if not going_on:
            break
        active = dealt.filter("rest IS NOT NULL").select(
            "own", F.col("next").alias("bucket"), "rest"
        )
        width *= growth
    done = [_with_kept(r) for r in rounds]
    return reduce(DataFrame.unionByName, done).select("own.*", "keep_id", "group_size", "kept")


def _with_kept(done: DataFrame) -> DataFrame:
    """Whether a row stays: of a group's rows with the largest doc_id, the first."""
    last = (F.col("group_size") > 1) & F.col("own.doc_id").eqNullSafe(F.col("keep_id"))
    others = done.filter(~last).withColumn("kept", F.col("group_size") == 1)
    firsts = done.filter(last).groupBy("next").agg(F.min("row").alias("row")).select("row")
    lasts = done.filter(last).join(firsts.withColumn("kept", F.lit(True)), "row", "left")
    lasts = lasts.withColumn("kept", F.coalesce("kept", F.lit(False)))
    return others.unionByName(lasts)
