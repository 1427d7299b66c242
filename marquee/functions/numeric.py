"""Aggregates whose rounding must not depend on floating point or on the partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rating columns are decimal(3,1). Widening to 8 digits lets sums reach 10^17 while they stay
# inside Spark's long-backed decimals (18 digits), the ones code generation handles natively.
_SUMMABLE = T.DecimalType(8, 1)


def exact_avg(col: Column, scale: int = 2) -> Column:
    """Average of a decimal(_, 1) column, rounded half-up once, as double.

    ``avg`` on a short decimal first cuts the quotient to five digits, and rounding that
    again moves 5.0049995 to 5.01; the plain quotient of the two sums keeps 21 digits.
    """
    quotient = F.sum(col.cast(_SUMMABLE)) / F.count(col)
    return F.round(quotient, scale).cast("double")


def exact_stddev(col: Column, scale: int = 2) -> Column:
    """Sample standard deviation of a decimal(_, 1) column, from exact integer sums.

    The result is the same whatever order the partitions merge in. NULL below two values.
    """
    tenths = (col.cast(_SUMMABLE) * 10).cast("bigint")
    n = F.count(col).cast("decimal(19,0)")
    total = F.sum(tenths).cast("decimal(19,0)")
    squares = F.sum(tenths * tenths).cast("decimal(19,0)")
    spread = (n * squares - total * total).cast("double")
    pairs = (n * (n - 1)).cast("double")
    return F.when(F.count(col) > 1, F.round(F.sqrt(spread / pairs) / 10, scale))


def median(col: Column, scale: int = 2) -> Column:
    """Interpolated median. The aggregation buffer holds one counter per distinct value."""
    return F.round(F.percentile(col, F.lit(0.5)), scale)
