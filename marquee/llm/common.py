"""Helpers the operators of this package share."""

from __future__ import annotations

import string
import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.session import shared_dir

#: Java regular expression for a blank.
BLANK = r"[\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\x0c\r"
OUT_ROWS = 4096
OUT_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` computed once into the shared folder; lost executors cost no recomputation."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(column: Column) -> Column:
    """A-Z lowered; ``lower`` does just that, and faster, to text of ASCII alone."""
    plain = F.octet_length(column) == F.char_length(column)
    others = F.translate(column, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(plain, F.lower(column)).otherwise(others)


def with_row_key(df: DataFrame, first: str, second: str) -> DataFrame:
    """``df`` with a row key of two longs: doc_id (0 for null), and a hash of doc_id and text.

    Rows with equal doc_id and text share a key: they are one document, given twice.
    """
    return df.withColumns(
        {
            first: F.coalesce(F.col("doc_id"), F.lit(0).cast("long")),
            second: F.xxhash64("doc_id", "text"),
        }
    )


def running_base(totals: DataFrame, part: str, total: str, base: str) -> DataFrame:
    """(part, base): the sum of ``total`` over all earlier parts.

    One row per written partition or file reaches the unpartitioned window, never rows of data.
    """
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        part, F.coalesce(F.sum(total).over(earlier), F.lit(0)).cast("long").alias(base)
    )


def table_of_bits(hashes: DataFrame, column: str, bits: int) -> Broadcast[bytes]:
    """A broadcast table of 2 ** ``bits`` bits, those set that the top bits of a hash name.

    Its size is fixed: the driver receives at most a word of 64 bits for each 64 of the table.
    """
    place = F.shiftrightunsigned(F.col(column), 64 - bits)
    words = (
        hashes.groupBy(F.shiftright(place, 6).cast("int").alias("at"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, int(shiftrightunsigned({column}, {64 - bits}) & 63))")).alias("word"))
    )
    table = np.zeros(1 << (bits - 6), dtype="<i8")
    for batch in words.toArrow().to_batches():
        table[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return hashes.sparkSession.sparkContext.broadcast(table.tobytes())


def memo() -> dict[str, Any]:
    """A dictionary that lives as long as the Python worker, for loaded files and caches.

    The package travels by value, so its own globals last for one task only.
    """
    return sys.modules.setdefault("_marquee_memo", types.ModuleType("_marquee_memo")).__dict__


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def rows_mapped(
    df: DataFrame, function: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str
) -> DataFrame:
    """``function`` over each partition's rows as tuples, in and out in bounded Arrow batches."""
    target = T.StructType.fromDDL(schema)
    arrow = arrow_schema(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def incoming() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(column.to_pylist() for column in batch.columns))

        rows: list[tuple] = []
        held = 0
        for row in function(incoming()):
            rows.append(row)
            held += sum(len(v) for v in row if isinstance(v, str | bytes))
            if len(rows) >= OUT_ROWS or held >= OUT_BYTES:
                yield _batch(rows, arrow)
                rows, held = [], 0
        if rows:
            yield _batch(rows, arrow)

    return df.mapInArrow(run, target)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    arrays = [pa.array(values, type=field.type) for values, field in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def found(text: str, pattern: str, shown: str, kind: str) -> str:
    """SQL for an array of ``kind``: what ``shown`` makes of each match of ``pattern`` in ``text``.

    Matches are leftmost and do not overlap. ``shown`` sees start and end (code points from 0, end
    exclusive), m, and the texts before and after, up to the third match of ``pattern`` to that
    side. The text between the matches gives the positions, so a match must not be empty.

    An array grows by copies, so positions are added up in blocks of about the root of the
    number of matches, first over the blocks, then within each.
    """
    quoted = "r'" + pattern.replace("'", r"\x27") + "'"
    block = "sequence(b * z.block, least((b + 1) * z.block, size(z.ms)) - 1)"
    width = "char_length(z.gaps[i]) + char_length(z.ms[i])"
    left = [f"coalesce(get(z.gaps, i - {k}), ''), coalesce(get(z.ms, i - {k}), '')" for k in (2, 1)]
    right = [f"get(z.ms, i + {k}), get(z.gaps, i + {k + 1})" for k in (1, 2)]
    for name, sql in {
        "x.start": "(done.at + char_length(z.gaps[i]))",
        "x.end": f"(done.at + {width})",
        "x.before": f"concat({', '.join(left)}, z.gaps[i])",
        "x.after": f"concat_ws('', z.gaps[i + 1], {', '.join(right)})",
        "x.m": "z.ms[i]",
    }.items():
        shown = shown.replace(name, sql)
    nothing = f"from_json('[]', 'array<{kind}>')"
    blocks = "sequence(0, (size(z.ms) - 1) div z.block)"
    return f"""flatten(transform(
      transform(
        array(struct(regexp_extract_all({text}, {quoted}, 0) AS ms, split({text}, {quoted}, -1) AS gaps)),
        z -> struct(z.ms AS ms, z.gaps AS gaps, int(ceil(sqrt(greatest(size(z.ms), 1)))) AS block)),
      z -> IF(size(z.ms) = 0, {nothing}, flatten(zip_with(
        {blocks},
        aggregate({blocks}, struct(0 AS at, array_repeat(0, 0) AS all),
          (sum, b) -> struct(
            sum.at + aggregate({block}, 0, (w, i) -> w + {width}) AS at,
            concat(sum.all, array(sum.at)) AS all),
          sum -> sum.all),
        (b, at) -> aggregate({block}, struct(at AS at, {nothing} AS found),
          (done, i) -> struct(done.at + {width} AS at, concat(done.found, array({shown})) AS found),
          done -> done.found))))))"""


def found_if(text: str, pattern: str, hint: str, shown: str, kind: str, keep: str = "true") -> str:
    """``found`` for texts that match the cheap ``hint``; else empty. ``keep``: on each x."""
    return f"""filter(IF({text} rlike r'{hint}', {found(text, pattern, shown, kind)},
        from_json('[]', 'array<{kind}>')), x -> {keep})"""
