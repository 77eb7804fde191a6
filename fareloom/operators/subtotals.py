"""Subtotals over several levels at once, and the first rows of each group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Partial results of each kind of measure at the finest level, and how those of several groups are merged.
_PARTIALS = {"sum": ("sum",), "count": ("count",), "min": ("min",), "max": ("max",), "mean": ("sum", "count")}
_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
_FIRST = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def rollup_sets(by: Sequence[str]) -> list[list[str]]:
    """All prefixes of the columns, longest first."""
    return [list(by[:k]) for k in range(len(by), -1, -1)]


def cube_sets(by: Sequence[str]) -> list[list[str]]:
    """All subsets of the columns, largest first."""
    return [list(some) for k in range(len(by), -1, -1) for some in combinations(by, k)]


def subtotals(
    df: DataFrame,
    by: Sequence[str],
    sets: Sequence[Sequence[str]],
    measures: Mapping[str, tuple[str, Column]],
    level: str = "level",
) -> DataFrame:
    """One row per group of every set of columns: ``by`` (null where a set lacks the column), ``level``, measures.

    ``level`` is the grouping id, a bit per column of ``by``, set where the column is added up, the first column highest;
    it tells a null value from a subtotal. A measure is a kind (sum, count, min, max, mean) and a column.

    The rows are grouped once, at the finest level. Only the partial results, at most one row per group and map task,
    are expanded to the other levels, instead of every row once per set.
    """
    partial = {
        (name, part): _FIRST[part](column).alias(f"{name} {part}")
        for name, (kind, column) in measures.items()
        for part in _PARTIALS[kind]
    }
    finest = df.groupBy(*by).agg(*partial.values())
    merged = {(name, part): _MERGE[part](f"`{name} {part}`") for name, part in partial}
    results = [
        (merged[name, "sum"] / merged[name, "count"] if kind == "mean" else merged[name, kind]).alias(name)
        for name, (kind, _) in measures.items()
    ]
    grouped = finest.groupingSets([[F.col(c) for c in some] for some in sets], *[F.col(c) for c in by])
    return grouped.agg(F.grouping_id().alias(level), *results)


def top_rows(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, *, ties: bool = True, rank: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of each group; with ``ties`` also those that equal the k-th in the order.

    The filter on the rank lets Spark cut groups in every task before the shuffle (``WindowGroupLimit``), so a group with
    a third of all rows reaches its reducer as ``k`` rows and ties per task.
    """
    own = Window.partitionBy(*by).orderBy(*order)
    place = F.rank() if ties else F.row_number()
    return df.withColumn(rank, place.over(own)).where(F.col(rank) <= k)
