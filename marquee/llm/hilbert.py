"""Shards along a Hilbert curve through several metadata dimensions, for file pruning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import running_base, written


def hilbert_index(axes: str, n: int, bits: int) -> Column:
    """Position (long) on the Hilbert curve; ``axes``: SQL for an array of n longs below 2^bits.

    Skilling's transform: undo the excess rotations from the highest bit down, Gray-code the
    axes, then interleave their bits, highest first. A null axis makes the position null.
    """
    none = "array_repeat(0, 0)"
    steps = f"sequence(0, {(bits - 1) * n - 1})" if bits > 1 else none
    upper = f"sequence(1, {bits - 1})" if bits > 1 else none
    # Step k works on bit bits - 1 - k div n of axis k % n: where it is set the lower bits of
    # axis 0 flip, else they swap with those of the axis.
    bit = f"int({bits - 1} - k div {n})"
    low = f"(shiftleft(1L, {bit}) - 1)"
    axis = f"element_at(x, int(k % {n}) + 1)"
    turned = f"""aggregate({steps}, {axes}, (x, k) -> transform(x, (v, i) ->
        IF(getbit({axis}, {bit}) = 1,
           IF(i = 0, v ^ {low}, v),
           IF(i = 0 OR i = k % {n}, v ^ ((x[0] ^ {axis}) & {low}), v))))"""
    # Running xor over the axes; then all flip by the parity of the last axis' higher bits.
    gray = f"""transform(sequence(1, {n}), i ->
        aggregate(slice(t, 1, i), 0L, (a, v) -> a ^ v))"""
    flips = f"""aggregate({upper}, 0L, (f, b) ->
        IF(getbit(element_at(g, -1), b) = 1, f ^ (shiftleft(1L, b) - 1), f))"""
    index = f"""aggregate(sequence(0, {bits * n - 1}), 0L, (done, k) -> done * 2 +
        getbit(element_at(g, int(k % {n}) + 1) ^ f, {bit}))"""
    # One-element transforms name the intermediate values, so that each is computed once.
    return F.expr(
        f"transform(transform(array({turned}), t -> {gray}), g ->"
        f" transform(array({flips}), f -> {index})[0])[0]"
    )


def _number(docs: DataFrame, dimension: str) -> Column | None:
    """A dimension with an order as a number; None for other types."""
    kind = docs.schema[dimension].dataType
    if isinstance(kind, T.NumericType):
        return F.col(dimension)
    if isinstance(kind, T.DateType):
        return F.unix_date(dimension)
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return F.unix_micros(F.col(dimension).cast("timestamp"))
    return None


def _cells(docs: DataFrame, dimensions: Sequence[str], bits: int) -> list[Column]:
    """A coordinate per dimension: numbers and times by quantiles over all rows, others by hash."""
    numbers = {d: n for d in dimensions if (n := _number(docs, d)) is not None}
    levels = 1 << bits
    cuts: dict[str, list] = {}
    if numbers:
        shares = [i / levels for i in range(1, levels)]
        row = docs.agg(*(F.percentile_approx(n, shares).alias(d) for d, n in numbers.items())).head()
        cuts = {d: sorted(set(row[d] or [])) for d in numbers}

    def cell(d: str) -> Column:
        if d in cuts:
            bounds = F.array(*(F.lit(v) for v in cuts[d] or [0]))
            place = F.size(F.filter(bounds, lambda bound: bound < numbers[d]))
        else:
            place = F.pmod(F.xxhash64(d), F.lit(levels))
        return F.when(F.col(d).isNull(), F.lit(0)).otherwise(place).cast("long")

    return [cell(d) for d in dimensions]


def _dealt(placed: DataFrame, order: Sequence[str], part_bytes: int) -> DataFrame:
    """``placed`` (curve, tie, bytes and more) in partitions of about equal bytes along the curve.

    The bytes of each place on the curve, at most as many rows as the curve has places, are
    added up along it. Within a place rows are spread by ``tie``, so that one place of many or
    long rows is several partitions too. The order is that of curve, then tie.
    """
    places = placed.groupBy("curve").agg(F.sum("bytes").alias("total"))
    places = written(running_base(places, "curve", "total", "base").join(places, "curve"), "places")
    whole = max(1, places.agg(F.sum("total")).head()[0] or 0)
    parts = -(-whole // part_bytes)
    share = F.col("tie") / F.lit(float(1 << 63))
    at = (F.col("base") + share * F.col("total")) * parts / whole
    part = F.least(F.lit(parts - 1), F.floor(at)).cast("int")
    dealt = placed.join(F.broadcast(places), "curve").withColumn("part", part)
    return dealt.repartitionById(parts, "part").sortWithinPartitions(*order)


def assign_shards(
    docs: DataFrame,
    dimensions: Sequence[str],
    shards: int,
    bits: int = 6,
    keys: Sequence[str] = (),
    carried: Sequence[str] = (),
    size: Column | None = None,
    part_bytes: int = 32 << 20,
) -> DataFrame:
    """``keys`` of all rows with their curve position, shard (0 to shards - 1) and slot in it.

    ``carried``: further columns, which take no part in the order; ``size``: a row's bytes, from
    which the shuffle makes partitions of about ``part_bytes``.

    Rows are sorted by curve position, then by a hash of ``keys``, then by ``keys``, and cut into
    runs whose lengths differ by one at most. Only keys, positions and what is carried are
    shuffled. A null dimension counts as 0; rows that agree in all keys are interchangeable; an
    empty table gives no rows. Sorted partitions number their rows, and running sums over the
    written partitions make the numbers global.
    """
    axes = ", ".join(f"a{i}" for i in range(len(dimensions)))
    curve = hilbert_index(f"array({axes})", len(dimensions), bits)
    cells = [c.alias(f"a{i}") for i, c in enumerate(_cells(docs, dimensions, bits))]
    kept = F.struct(*keys, *carried).alias("own")
    tie = F.shiftrightunsigned(F.xxhash64(*(keys or dimensions)), 1).alias("tie")
    weight = (F.lit(100) if size is None else size).cast("long").alias("bytes")
    placed = docs.select(kept, tie, weight, *cells)
    placed = placed.select("own", "tie", "bytes", curve.alias("curve"))
    order = ["curve", "tie", *(f"own.{k}" for k in keys)]
    numbered = written(
        _dealt(placed, order, part_bytes)
        .drop("base", "total", "bytes")
        .withColumns({"part": F.spark_partition_id(), "row": F.monotonically_increasing_id()})
        .withColumn("row", F.col("row").bitwiseAND((1 << 33) - 1)),
        "curve",
        compression="zstd",
    )
    totals = numbered.groupBy("part").agg(F.count("*").alias("total"))
    based = running_base(totals, "part", "total", "base")  # as many rows as partitions
    n = max(1, numbered.count())
    ranked = numbered.join(F.broadcast(based), "part").withColumn(
        "rank", F.col("base") + F.col("row")
    )
    # Shard s begins at rank floor(s * n / shards).
    return (
        ranked.withColumn("shard", F.expr(f"((rank + 1) * {shards} - 1) div {n}"))
        .withColumn("slot", F.expr(f"rank - shard * {n} div {shards}"))
        .select(
            "own.*",
            F.col("curve").alias("curve_position"),
            F.col("shard").cast("int").alias("shard"),
            "slot",
        )
    )


def _write(placed: DataFrame, folder: str) -> None:
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(
        folder, compression="zstd"
    )


def cut_shards(
    docs: DataFrame,
    dimensions: Sequence[str],
    shards: int,
    folder: str,
    bits: int = 6,
    keys: Sequence[str] = (),
    row: str = "row",
    size: Column | None = None,
) -> DataFrame:
    """Write the struct column ``row`` of all rows as one folder a shard; the files, to be read.

    They hold ``row``, curve_position and slot, each file in slot order. Rows travel with their
    positions, so nulls and repeated rows are rows like others.
    """
    assigned = assign_shards(docs, dimensions, shards, bits, keys, [row], size)
    placed = assigned.select(row, "curve_position", "slot", "shard")
    _write(placed, folder)
    return docs.sparkSession.read.schema(placed.schema).parquet(folder)
