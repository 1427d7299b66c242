"""Spans of texts as SQL over columns: kinds of matches, their order and digests."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import found_if


class Kind(NamedTuple):
    name: str
    hint: str  # texts without a match of this have no span of the kind
    pattern: str
    keep: str = "true"  # SQL on a match x (start, end, m); failing matches are dropped


SPAN = "struct<ord:int,start:int,end:int,m:string>"
#: Spans meet in cells of so many code points when it is asked which of them overlap.
CELL = 256


def all_spans(text: str, kinds: Sequence[Kind], first: int = 0, more: str = "", types: str = "") -> str:
    """SQL for array<SPAN>: matches of all kinds; ord numbers the kinds from ``first``.

    ``more`` adds fields worked out from x (see ``found``), of ``types``.
    """
    kind = f"{SPAN[:-1]}{types}>"
    each = [
        found_if(
            text,
            k.pattern,
            k.hint,
            f"struct({first + i} AS ord, x.start AS start, x.end AS end, x.m AS m{more})",
            kind,
            k.keep,
        )
        for i, k in enumerate(kinds)
    ]
    return f"concat({', '.join(each)})"


def apart(spans: DataFrame, others: DataFrame) -> DataFrame:
    """The rows of ``spans`` (d, t, span) that overlap no span of ``others`` in their text.

    Both stand in the cells they touch and meet by text and cell: no pairs are made, and a text
    of many spans is many cells.
    """
    cells = f"explode(sequence(span.start div {CELL}, (span.end - 1) div {CELL})) AS cell"
    own = spans.selectExpr("d", "t", "span", cells)
    there = others.selectExpr("d AS od", "t AS ot", "span.start AS first", "span.end AS last", cells)
    there = there.withColumnRenamed("cell", "there")
    meets = (
        (F.col("d") == F.col("od"))
        & (F.col("t") == F.col("ot"))
        & (F.col("cell") == F.col("there"))
        & (F.col("first") < F.col("span.end"))
        & (F.col("span.start") < F.col("last"))
    )
    struck = own.join(there, meets, "left_semi").selectExpr("d", "t", "span AS hit").distinct()
    same = [F.col(f"span.{f}") == F.col(f"hit.{f}") for f in ("ord", "start", "end")]
    struck = struck.selectExpr("d AS od", "t AS ot", "hit")
    return spans.join(
        struck, [F.col("d") == F.col("od"), F.col("t") == F.col("ot"), *same], "left_anti"
    )


def listed(spans: str, names: Sequence[str], by: Sequence[str]) -> Column:
    """kind:start:end of all spans, sorted by the fields ``by``, joined by commas."""
    kinds = "array(" + ", ".join(f"'{n}'" for n in names) + ")"
    keys = ", ".join(f"x.{f}" for f in [*by, "end"])
    ordered = f"array_sort(transform({spans}, x -> struct({keys})))"
    return F.expr(
        f"array_join(transform({ordered}, x ->"
        f" concat({kinds}[x.ord], ':', x.start, ':', x.end)), ',')"
    )


def count_of(spans: str, ord: int) -> Column:
    return F.expr(f"size(filter({spans}, x -> x.ord = {ord}))").cast("long")
