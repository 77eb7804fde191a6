"""Sessions: rows of one key with no gap longer than a bound between neighbours."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.operators.ranges import axis, range_number

RANGES = 64


def sessions(
    df: DataFrame, key: str, time: str, gap: int, sums: Mapping[str, Column] | None = None, ranges: int = RANGES
) -> DataFrame:
    """``key, session, start, end, rows`` and the given sums, one row per session.

    Sessions of a key count from 1 in order of time. ``gap`` is in units of the axis (microseconds for timestamps, days
    for dates): a longer distance opens a new session, an equal one does not. Rows without a time belong to no session;
    rows without a key form sessions of their own.

    Rows of one key and moment are added up before anything is ordered. Then two levels of prefix sums number the
    sessions: within a key and a range of time, and over the ranges of a key, of which there are ``ranges`` at most. A
    key with a third of all rows is as many sorted groups as there are ranges.
    """
    sums = dict(sums or {})
    at = axis(F.col(f"`{time}`"), df.schema[time].dataType)
    moments = (
        df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{time}`").alias("time"), at.alias("at"), *[c.alias(n) for n, c in sums.items()])
        .where("at IS NOT NULL")
        .groupBy("key", "time", "at")
        .agg(F.count("*").alias("rows"), *[F.sum(n).alias(n) for n in sums])
    )
    moments = moments.withColumn("range", range_number(df.select(at.alias("at")), "at", ranges))
    own = Window.partitionBy("key", "range").orderBy("at")
    opens = F.coalesce((F.col("at") - F.lag("at").over(own)) > gap, F.lit(False)).cast("long")
    local = moments.withColumn("opens", opens).withColumn("place", F.sum("opens").over(own))
    by_range = Window.partitionBy("key").orderBy("range")
    joins_on = F.coalesce((F.col("first") - F.lag("last").over(by_range)) <= gap, F.lit(False))
    heads = (
        local.groupBy("key", "range")
        .agg(F.min("at").alias("first"), F.max("at").alias("last"), F.sum("opens").alias("opened"))
        .withColumn("head", F.when(joins_on, 0).otherwise(1))
        .withColumn("upto", F.sum(F.col("opened") + F.col("head")).over(by_range))
        .select(F.col("key").alias("head_key"), F.col("range").alias("head_range"), (F.col("upto") - F.col("opened")).alias("base"))
    )
    same = F.col("key").eqNullSafe(F.col("head_key")) & (F.col("range") == F.col("head_range"))
    numbered = local.join(heads, same).withColumn("session", F.col("base") + F.col("place"))
    return (
        numbered.groupBy("key", "session")
        .agg(
            F.min("time").alias("start"),
            F.max("time").alias("end"),
            F.sum("rows").alias("rows"),
            *[F.sum(n).alias(n) for n in sums],
        )
        .withColumnRenamed("key", key)
    )
