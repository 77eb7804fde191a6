"""Date and hour keys, partition values and durations.

The keys are built with integer arithmetic on date parts instead of formatting text and parsing it again: cheaper per
row, inside whole-stage codegen, and independent of the session time zone for ``timestamp_ntz`` input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def date_key(ts: ColumnLike) -> Column:
    """Integer ``yyyyMMdd``; null for years that no longer fit an int."""
    return _day_number(as_column(ts)).try_cast("int")


def hour_key(ts: ColumnLike) -> Column:
    """Integer ``yyyyMMddHH``; null once that no longer fits an int (after the year 2147)."""
    ts = as_column(ts)
    return (_day_number(ts) * 100 + F.hour(ts)).try_cast("int")


def _day_number(ts: Column) -> Column:
    return F.year(ts).cast("bigint") * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def date_text(ts: ColumnLike) -> Column:
    """Text ``yyyy-MM-dd``."""
    return F.to_date(as_column(ts)).cast("string")


def hour_of_day(ts: ColumnLike) -> Column:
    return F.hour(as_column(ts))


def _padded(part: Column, width: int) -> Column:
    text = part.cast("string")
    return F.when(part < 10 ** (width - 1), F.lpad(text, width, "0")).otherwise(text)


def partition_values(ts: ColumnLike) -> dict[str, Column]:
    """Zero-padded ``year``, ``month`` and ``day`` as text, in directory order."""
    ts = as_column(ts)
    return {
        "year": _padded(F.year(ts), 4),
        "month": _padded(F.month(ts), 2),
        "day": _padded(F.dayofmonth(ts), 2),
    }


def elapsed_seconds(start: ColumnLike, end: ColumnLike) -> Column:
    """Whole seconds from start to end as double; negative when end comes first."""
    return (F.unix_timestamp(as_column(end)) - F.unix_timestamp(as_column(start))).cast("double")


def minutes(seconds: ColumnLike) -> Column:
    return (as_column(seconds) / 60).cast("double")
