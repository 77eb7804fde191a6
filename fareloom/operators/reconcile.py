"""Two tables with the same columns as multisets: which partitions differ, and by which rows.

Every partition gets a digest that does not depend on the order of its rows: their number and two sums of 64-bit row
hashes, one table counted up and the other down. Equal partitions come to zero everywhere. Only partitions that differ
are read again, row by row.

Both sums of unequal partitions are zero by chance once in about 10^38 cases; the hashes guard against mistakes, not
against somebody who makes rows on purpose. Null equals null, and a null is told from every value. Columns that Spark
can't group by (maps, variants) are refused by Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SIGN = "counted up or down"
_SALT = "second hash"


def _require_same_columns(staged: DataFrame, published: DataFrame, by: Sequence[str]) -> None:
    kinds, others = dict(staged.dtypes), dict(published.dtypes)
    if kinds != others:
        raise ValueError(f"columns differ: {sorted(set(kinds.items()) ^ set(others.items()))}")
    if not by or not set(by) <= set(kinds):
        raise ValueError(f"partition columns {list(by)} are none of {sorted(kinds)}")


def _signed(staged: DataFrame, published: DataFrame) -> DataFrame:
    return staged.withColumn(_SIGN, F.lit(1)).unionByName(published.withColumn(_SIGN, F.lit(-1)))


def _columns(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{name}`") for name in names]


def differing_partitions(staged: DataFrame, published: DataFrame, by: Sequence[str]) -> DataFrame:
    """Values of ``by`` whose rows are not the same multiset, with ``more_rows``: staged less published.

    One pass over both tables; each task sends a row per partition to the shuffle.
    """
    _require_same_columns(staged, published, by)
    fields = [part for c in _columns(sorted(set(staged.columns) - set(by))) for part in (c, c.isNull())]
    # 28 digits leave ten for the number of rows.
    hashes = [F.xxhash64(F.lit(salt), *fields).cast("decimal(28,0)") for salt in (0, _SALT)]
    sums = [F.sum(h * F.col(_SIGN)) for h in hashes]
    compared = _signed(staged, published).groupBy(*_columns(by)).agg(
        F.sum(_SIGN).alias("more_rows"), *[s.alias(f"{_SIGN} {k}") for k, s in enumerate(sums)]
    )
    unequal = (F.col("more_rows") != 0) | (F.col(f"{_SIGN} 0") != 0) | (F.col(f"{_SIGN} 1") != 0)
    return compared.where(unequal).select(*_columns(by), "more_rows")


def surplus_rows(
    staged: DataFrame, published: DataFrame, by: Sequence[str], surplus: str = "surplus"
) -> DataFrame:
    """Rows that one table holds more often than the other, with ``surplus``: copies staged less copies published.

    The differing partitions' values come to the driver, at most as many as there are directories, and reach the scans
    as partition filters, so no file of an equal partition is read twice. Copies are counted in tasks before the
    shuffle.
    """
    if surplus in staged.columns:
        raise ValueError(f"the tables have a column {surplus}")
    key = F.to_json(F.struct(*_columns(by)))
    unequal = [row[0] for row in differing_partitions(staged, published, by).select(key).collect()]
    rows = _signed(staged.where(key.isin(unequal)), published.where(key.isin(unequal)))
    counted = rows.groupBy(*_columns(staged.columns)).agg(F.sum(_SIGN).alias(surplus))
    return counted.where(F.col(surplus) != 0)
