"""Joins of closed intervals that overlap, by equality of bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.operators.ranges import axis

# Bins of level k are 4**k units wide. An interval's own level is the first whose bins are as wide as it is long, so it
# touches two of them at most.
LEVELS = 30


def _binned(df: DataFrame, on: Sequence[str], start: str, end: str, side: str) -> DataFrame:
    """Keys, the row as a struct, its ends on the long axis and its own level. Empty and unknown intervals are gone."""
    ends = [axis(F.col(f"`{name}`"), df.schema[name].dataType) for name in (start, end)]
    length = F.greatest(F.col(f"{side}_end") - F.col(f"{side}_start"), F.lit(0)) + 1
    whole = F.struct(*[F.col(f"`{name}`") for name in df.columns if name not in on])
    return (
        df.select(*on, whole.alias(side), ends[0].alias(f"{side}_start"), ends[1].alias(f"{side}_end"))
        .where(F.col(f"{side}_start") <= F.col(f"{side}_end"))
        .withColumn(f"{side}_level", F.least(F.ceil(F.log2(length) / 2), F.lit(LEVELS)).cast("int"))
    )


def _bin(position: Column, level: Column) -> Column:
    """Number of the bin that holds a position; rounds down for negative positions too."""
    return F.call_function("shiftright", position, 2 * level)


def _levels(df: DataFrame, column: str) -> list[int]:
    return sorted(row[0] for row in df.select(column).distinct().collect())


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    *,
    left_interval: tuple[str, str],
    right_interval: tuple[str, str],
    on: Sequence[str] = (),
) -> DataFrame:
    """All pairs of rows with equal keys whose closed intervals share a point: keys, left columns, right columns.

    Ends are dates, timestamps or whole numbers, of one kind on both sides; a point is an interval from itself to
    itself. Intervals that end before they start or lack an end match nothing.

    The pair meets at the level of its longer interval: that side is in its own bins there, the other in the bins of
    every level of the opposite side from its own up. Neither is ever cut into more than two bins of a level, however
    lengths differ. Of the bins that a pair shares, the one with the later start counts. Bins are join keys, so Catalyst
    plans an equal join, and adaptive execution splits crowded bins.
    """
    clash = (set(left.columns) & set(right.columns)) - set(on)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    one, other = _binned(left, on, *left_interval, "left"), _binned(right, on, *right_interval, "right")

    def spread(df: DataFrame, side: str, levels: list[int], longer: bool) -> DataFrame:
        """Rows in the bins of other levels: of those above their own, or from their own up."""
        above = F.col("level") > F.col(f"{side}_level") if longer else F.col("level") >= F.col(f"{side}_level")
        some = df.withColumn("level", F.explode(F.array(*[F.lit(k) for k in levels]).cast("array<int>"))).where(above)
        return in_bins(some, side)

    def in_bins(df: DataFrame, side: str) -> DataFrame:
        first, last = (_bin(F.col(f"{side}_{end}"), F.col("level")) for end in ("start", "end"))
        return df.withColumn("bin", F.explode(F.sequence(first, last)))

    def met(a: DataFrame, b: DataFrame) -> DataFrame:
        later = F.greatest("left_start", "right_start")
        pairs = a.join(b, [*on, "level", "bin"])
        pairs = pairs.where((F.col("left_start") <= F.col("right_end")) & (F.col("right_start") <= F.col("left_end")))
        return pairs.where(F.col("bin") == _bin(later, F.col("level"))).select(*on, "left.*", "right.*")

    own_left = in_bins(one.withColumn("level", F.col("left_level")), "left")
    own_right = in_bins(other.withColumn("level", F.col("right_level")), "right")
    right_longer = met(spread(one, "left", _levels(other, "right_level"), False), own_right)
    left_longer = met(own_left, spread(other, "right", _levels(one, "left_level"), True))
    return right_longer.unionByName(left_longer)
