"""Row measures: speed, efficiency, fare totals, ratios, currency amounts and flags."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from fareloom.functions.temporal import ColumnLike, as_column

# A trip has an efficiency only above both limits.
MIN_SECONDS = 120
MIN_MILES = 1


def miles_per_hour(miles: ColumnLike, seconds: ColumnLike) -> Column:
    """Null for a zero duration instead of an ANSI division error."""
    return F.try_divide(as_column(miles), as_column(seconds) / 3600).cast("double")


def miles_per_minute(miles: ColumnLike, seconds: ColumnLike) -> Column:
    """Trip efficiency; null at or below either limit, for nulls and for NaN.

    Spark orders NaN above every number, so NaN is mapped to 0 before each comparison.
    """
    miles, seconds = as_column(miles).cast("double"), as_column(seconds).cast("double")
    long_enough = F.nanvl(seconds, F.lit(0.0)) > MIN_SECONDS
    far_enough = F.nanvl(miles, F.lit(0.0)) > MIN_MILES
    return F.when(long_enough & far_enough, miles / (seconds / 60))


def strict_total(*parts: ColumnLike) -> Column:
    """Sum from left to right; one null part makes the total null."""
    return reduce(add, [as_column(part) for part in parts])


def percent_of(part: ColumnLike, whole: ColumnLike) -> Column:
    return F.try_divide(as_column(part), as_column(whole)) * 100


def converted(amount: ColumnLike, rate: ColumnLike) -> Column:
    return as_column(amount) * as_column(rate)


def yes_no_flag(flag: ColumnLike) -> Column:
    """``Y`` / ``N`` text to boolean; blanks and other text become null, also under ANSI.

    Blanks are common in flags and are made null first: ``try_cast`` raises and catches an exception for every text
    it refuses, which costs more than the rest of a row.
    """
    text = as_column(flag).cast("string")
    return F.when(F.trim(text) != "", text).try_cast("boolean")
