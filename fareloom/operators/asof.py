"""As-of join: every fact gets the values that were last known for its key at its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.operators.lookups import ROWS_PER_PIECE, heavy_keys
from fareloom.operators.ranges import axis, range_number

_AT = "__at"
_RANGE = "__range"
_PIECE = "__piece"
_FACT = "__fact"
_HASH = "__group_hash"
RANGES = 64


def asof_join(
    facts: DataFrame,
    known: DataFrame,
    on: Sequence[str],
    *,
    fact_time: str,
    known_time: str,
    values: Sequence[str],
    within: int | None = None,
    at_column: str | None = None,
    ranges: int = RANGES,
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """Add the columns ``values`` of ``known`` to ``facts``, each with its last value that is not null.

    The last value is the one with the greatest ``known_time`` at or before ``fact_time`` (dates, timestamps or whole
    numbers, of one kind on both sides); of several at one moment, the greatest counts. ``within`` bounds its age in
    units of the axis: days for dates, microseconds for timestamps. ``at_column`` adds the position of the newest value
    used. Facts without a key, a time or an earlier value get nulls; every fact comes out exactly once.

    Facts and known values meet in a union, sorted by time within a key and a range of time, and what was known before
    a range comes from one row per key and range. So a key with most of the rows is spread over the ranges, and
    a key that is still heavy within a range is dealt into pieces, which repeat that range's known values only.
    """
    names = [f"__value{k}" for k in range(len(values))]
    usable = F.col(_AT).isNotNull()
    for key in on:
        usable = usable & F.col(f"`{key}`").isNotNull()
    dated = facts.withColumn(_AT, axis(F.col(f"`{fact_time}`"), facts.schema[fact_time].dataType))
    kept = [F.col(f"`{name}`") for name in facts.columns]
    rest = dated.where(~usable).select(F.struct(*kept).alias(_FACT))
    dated = dated.where(usable)

    moments = (
        known.withColumn(_AT, axis(F.col(f"`{known_time}`"), known.schema[known_time].dataType))
        .where(usable)
        .groupBy(*on, _AT)
        .agg(*[F.max(f"`{value}`").alias(name) for value, name in zip(values, names, strict=True)])
    )
    # Each value travels with its own position: they may come from different moments.
    placed = [F.when(F.col(n).isNotNull(), F.struct(F.col(_AT).alias("at"), F.col(n).alias("value"))).alias(n) for n in names]
    number = range_number(dated, _AT, ranges)
    rows = dated.select(*on, _AT, number.alias(_RANGE), F.struct(*kept).alias(_FACT))
    moments = moments.select(*on, _AT, number.alias(_RANGE), *placed)

    # What a range begins with: the last value of the ranges before it, for the keys and ranges that have facts.
    ends = moments.groupBy(*on, _RANGE).agg(*[F.max(n).alias(n) for n in names])
    nothing = [F.lit(None).cast(moments.schema[n].dataType).alias(n) for n in names]
    asked = rows.select(*on, _RANGE).distinct()
    before = Window.partitionBy(*on).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    begins = (
        ends.unionByName(asked.select(*on, _RANGE, *nothing))
        .groupBy(*on, _RANGE)
        .agg(*[F.max(n).alias(n) for n in names])
        .select(*on, _RANGE, F.lit(None).cast("long").alias(_AT), *[F.last(n, True).over(before).alias(n) for n in names])
    )

    group = F.xxhash64(*on, _RANGE)
    heavy = heavy_keys(rows, group, rows_per_piece)
    earlier = begins.unionByName(moments)
    if heavy:
        pieces = F.broadcast(facts.sparkSession.createDataFrame(heavy, f"{_HASH} long, __pieces int"))
        count = F.coalesce(F.col("__pieces"), F.lit(1))
        rows = rows.withColumn(_HASH, group).join(pieces, _HASH, "left")
        rows = rows.withColumn(_PIECE, F.pmod(F.xxhash64(F.to_json(_FACT)), count).cast("int")).drop(_HASH, "__pieces")
        earlier = earlier.withColumn(_HASH, group).join(pieces, _HASH, "left")
        earlier = earlier.withColumn(_PIECE, F.explode(F.sequence(F.lit(0), count - 1))).drop(_HASH, "__pieces")
    else:
        rows, earlier = (df.withColumn(_PIECE, F.lit(0)) for df in (rows, earlier))

    order = Window.partitionBy(*on, _RANGE, _PIECE).orderBy(F.asc_nulls_first(_AT), F.col(_FACT).isNotNull())
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = rows.unionByName(earlier, allowMissingColumns=True)
    met = met.withColumns({n: F.last(n, True).over(so_far) for n in names}).where(F.col(_FACT).isNotNull())
    if within is not None:
        young = {n: F.when(F.col(n)["at"] >= F.col(_AT) - within, F.col(n)) for n in names}
        met = met.withColumns(young)
    found: list[Column] = [F.col(n)["value"].alias(v) for n, v in zip(names, values, strict=True)]
    if at_column:
        used = [F.col(n)["at"] for n in names]
        found.append((F.greatest(*used) if len(used) > 1 else used[0]).alias(at_column))
    return met.select(f"{_FACT}.*", *found).unionByName(rest.select(f"{_FACT}.*"), allowMissingColumns=True)
