"""Distinct counts and quantiles from stored sketches: built once per partition, merged over any partitions later.

A day's facts are read once, when the day is written. Months, years or any other choice of days are answered from the
sketches: HyperLogLog sketches are united, and histograms with buckets of growing width are added up. The buckets bound
the relative error of a quantile by ``accuracy``, whatever the values, and do not depend on how rows were spread over
tasks, so running a day again gives the same histogram.

One table holds both, a row per partition, measure and bucket: ``measure``, ``bucket`` (null for distinct counts),
``rows`` and ``sketch`` (null for histograms). Its size follows the number of partitions, not that of the facts.

Nulls count nowhere. Quantiles leave out NaN and infinite values as well.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructType

from fareloom.sources.publishing import balanced

ACCURACY = 0.01
PRECISION = 12  # 4,096 registers: a standard error of about 1.3 %
_OWN = ("measure", "bucket", "rows", "sketch")


def _growth(accuracy: float) -> float:
    return (1 + accuracy) / (1 - accuracy)


def _shift(accuracy: float) -> int:
    """Makes the bucket of the smallest positive double 1 or more."""
    return math.ceil(745 / math.log(_growth(accuracy))) + 1


def bucket_of(value: Column, accuracy: float = ACCURACY) -> Column:
    """Bucket of a finite number: 0 for zero, the sign of the value otherwise; buckets are in the order of values."""
    x = value.cast("double")
    place = F.ceil(F.log(F.abs(x)) / math.log(_growth(accuracy))) + _shift(accuracy)
    return F.when(x == 0, 0).otherwise(F.signum(x) * place).cast("int")


def value_of(bucket: Column, accuracy: float = ACCURACY) -> Column:
    """The value that is within ``accuracy`` of everything in the bucket."""
    growth = _growth(accuracy)
    size = 2 * F.pow(F.lit(growth), F.abs(bucket) - _shift(accuracy)) / (growth + 1)
    return F.when(bucket == 0, 0.0).otherwise(F.signum(bucket) * size)


def sketched(
    df: DataFrame,
    by: Sequence[str],
    distinct: Mapping[str, Column],
    values: Mapping[str, Column],
    accuracy: float = ACCURACY,
    precision: int = PRECISION,
) -> DataFrame:
    """Sketches of each partition: of the distinct values of integer or text columns, of the sizes of numbers.

    Both aggregates are partial first, so a partition with a third of all rows reaches its reducers as one sketch, and
    one row per bucket, of each task.
    """
    clash = set(by) & set(_OWN)
    if clash or set(distinct) & set(values):
        raise ValueError(f"names taken twice: {sorted(clash or set(distinct) & set(values))}")
    keys = [F.col(f"`{c}`") for c in by]
    parts = []
    if distinct:
        made = df.groupBy(*keys).agg(*[F.hll_sketch_agg(c, precision).alias(f"sketch {n}") for n, c in distinct.items()])
        named = [F.struct(F.lit(n).alias("measure"), F.col(f"`sketch {n}`").alias("sketch")) for n in distinct]
        parts.append(
            made.select(*keys, F.inline(F.array(*named))).select(
                *keys, "measure", F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("long").alias("rows"), "sketch"
            )
        )
    if values:
        named = [F.struct(F.lit(n).alias("measure"), c.cast("double").alias("value")) for n, c in values.items()]
        finite = F.abs("value") < float("inf")
        parts.append(
            df.select(*keys, F.inline(F.array(*named)))
            .where(finite)
            .groupBy(*keys, "measure", bucket_of(F.col("value"), accuracy).alias("bucket"))
            .agg(F.count("*").alias("rows"))
            .withColumn("sketch", F.lit(None).cast("binary"))
        )
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def store(sketches: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace the sketches of the partitions at hand; those of all others stay."""
    writer = balanced(sketches, by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(path)


def stored(spark: SparkSession, path: str, by: StructType) -> DataFrame:
    """Sketches below a path; ``by`` gives the partition columns and their types."""
    schema = StructType()
    for name, kind in zip(_OWN, (StringType(), IntegerType(), LongType(), BinaryType()), strict=True):
        schema.add(name, kind)
    return spark.read.schema(StructType(schema.fields + by.fields)).parquet(path)


def distinct_counts(sketches: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """About how many different values each measure has over all partitions of a group."""
    own = sketches.where(F.col("sketch").isNotNull() & F.col("measure").isin(list(names)))
    united = [F.hll_union_agg(F.when(F.col("measure") == name, F.col("sketch"))) for name in names]
    return own.groupBy(*by).agg(*[F.hll_sketch_estimate(u).alias(n) for u, n in zip(united, names, strict=True)])


def quantiles(
    sketches: DataFrame, by: Sequence[str], name: str, at: Mapping[str, float], accuracy: float = ACCURACY
) -> DataFrame:
    """Quantiles of one measure over all partitions of a group, each within ``accuracy`` of an exact one.

    The quantile at ``q`` of ``n`` values is the one of rank ``ceil(q n)``, the first for ``q = 0``. Windows run over
    buckets, whose number the accuracy bounds.
    """
    counts = sketches.where(F.col("sketch").isNull() & (F.col("measure") == name)).groupBy(*by, "bucket")
    counts = counts.agg(F.sum("rows").alias("rows"))
    group = Window.partitionBy(*by)
    placed = counts.select(
        *by, "bucket", F.sum("rows").over(group.orderBy("bucket")).alias("rows"), F.sum("rows").over(group).alias("sketch")
    )
    reached = {label: F.col("rows") >= F.greatest(F.lit(1), F.ceil(F.lit(q) * F.col("sketch"))) for label, q in at.items()}
    return placed.groupBy(*by).agg(
        *[value_of(F.min(F.when(there, F.col("bucket"))), accuracy).alias(label) for label, there in reached.items()]
    )
