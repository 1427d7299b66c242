"""Array expressions: distinct elements, containment and overlap."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def sorted_distinct(array: Column) -> Column:
    """Distinct non-null elements in byte order, without lambdas, so it is compiled."""
    return F.sort_array(F.array_except(array, F.array(F.lit(None).cast("string"))))


def contains_all(array: Column, values: Iterable[str]) -> Column:
    """True when every value is an element (array containment)."""
    return reduce(lambda a, b: a & b, [F.array_contains(array, v) for v in values], F.lit(True))


def contains_any(array: Column, values: Iterable[str]) -> Column:
    """True when the arrays share a non-null element (array overlap)."""
    return reduce(lambda a, b: a | b, [F.array_contains(array, v) for v in values], F.lit(False))
