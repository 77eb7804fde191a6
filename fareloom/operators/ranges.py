"""Time axes as long numbers, and their division into ranges with about equally many rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, IntegralType, TimestampNTZType, TimestampType

# Accuracy of the quantile sketch; its size does not grow with the data.
ACCURACY = 10_000


def axis(column: Column, kind: DataType) -> Column:
    """Dates as days and timestamps as microseconds since 1970, whole numbers as they are; all as longs."""
    if isinstance(kind, TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), column)
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, IntegralType):
        return column.cast("long")
    raise TypeError(f"no time axis for {kind.simpleString()}")


def range_number(df: DataFrame, position: str, ranges: int) -> Column:
    """Number of the range that a long column falls into, from 0.

    The bounds are approximate quantiles from one pass over that column. They decide how rows are dealt, never what is
    computed. Many rows at one position stay in one range.
    """
    shares = [k / ranges for k in range(1, ranges)]
    if not shares:
        return F.lit(0)
    bounds = df.agg(F.percentile_approx(position, shares, ACCURACY)).first()[0] or []
    steps = [(F.col(position) >= bound).cast("int") for bound in sorted(set(bounds))]
    return reduce(lambda a, b: a + b, steps, F.lit(0))
