"""Grouped measures of a fact table by an attribute of a dimension.

Facts are aggregated by their foreign key before the join. A foreign key that holds a large share of all rows then
shrinks to one row per map task ahead of any shuffle; the join sees one row per key; and nothing has to be
broadcast by force: Catalyst and AQE broadcast the dimension when its size allows and otherwise merge-join two
inputs of at most one row per key. Counts, sums and means decompose exactly, also when a dimension key repeats.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_KEY = "__fact_key"
_DIM_KEY = "__dimension_key"


@dataclass(frozen=True)
class Measure:
    """One output column. ``kind`` is count, sum or mean; count takes no value."""

    name: str
    kind: str
    value: Column | None = None
    cast: str | None = None

    def partials(self) -> list[Column]:
        rows = F.count("*") if self.value is None else F.count(self.value)
        if self.kind == "count":
            columns = [rows]
        elif self.kind == "sum":
            columns = [F.sum(self.value)]
        elif self.kind == "mean":
            columns = [F.sum(self.value), rows]
        else:
            raise ValueError(f"unknown measure kind {self.kind!r}")
        return [column.alias(self.partial_name(i)) for i, column in enumerate(columns)]

    def merged(self) -> Column:
        result = F.sum(self.partial_name(0))
        if self.kind == "mean":
            result = F.try_divide(result, F.sum(self.partial_name(1)))
        return (result.cast(self.cast) if self.cast else result).alias(self.name)

    def partial_name(self, index: int = 0) -> str:
        return f"__{self.name}_{index}"


def count_rows(name: str) -> Measure:
    return Measure(name, "count")


def total(name: str, value: Column, cast: str | None = None) -> Measure:
    return Measure(name, "sum", value, cast)


def mean(name: str, value: Column) -> Measure:
    return Measure(name, "mean", value)


def joined_partials(
    facts: DataFrame,
    dimension: DataFrame,
    *,
    fact_key: str,
    dimension_key: str,
    attributes: Sequence[str],
    measures: Sequence[Measure],
    fact_groups: Mapping[str, Column] | None = None,
    how: str = "inner",
) -> DataFrame:
    """Partial measures per fact key (and fact-side group), with the dimension's attributes joined on."""
    groups = {_KEY: F.col(fact_key), **(fact_groups or {})}
    partial = facts.groupBy(*[column.alias(name) for name, column in groups.items()]).agg(
        *[column for measure in measures for column in measure.partials()]
    )
    lookup = dimension.select(
        F.col(dimension_key).alias(_DIM_KEY), *[F.col(name).alias(name) for name in attributes]
    )
    return partial.join(lookup, partial[_KEY] == lookup[_DIM_KEY], how).drop(_KEY, _DIM_KEY)


def rollup_by_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    *,
    fact_key: str,
    dimension_key: str,
    group_by: Sequence[str],
    measures: Sequence[Measure],
    fact_groups: Mapping[str, Column] | None = None,
    how: str = "inner",
) -> DataFrame:
    """Measures by dimension attributes and optional fact-side groups.

    ``how="inner"`` drops facts without a dimension row; ``how="left"`` gathers them in a null group.
    """
    partial = joined_partials(
        facts,
        dimension,
        fact_key=fact_key,
        dimension_key=dimension_key,
        attributes=group_by,
        measures=measures,
        fact_groups=fact_groups,
        how=how,
    )
    return partial.groupBy(*group_by, *(fact_groups or {})).agg(*[measure.merged() for measure in measures])
