"""The k groups with the most rows, and their rows by hour of day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.operators.rollup import count_rows, joined_partials, rollup_by_dimension


def top_groups(
    facts: DataFrame, dimension: DataFrame, *, fact_key: str, dimension_key: str, group: str, k: int, count: str
) -> DataFrame:
    """The k largest groups; ties at the cut go to the smaller group name."""
    counts = rollup_by_dimension(
        facts,
        dimension,
        fact_key=fact_key,
        dimension_key=dimension_key,
        group_by=[group],
        measures=[count_rows(count)],
    )
    return counts.orderBy(F.desc(count), group).limit(k)


def hourly_counts_of_top_groups(
    facts: DataFrame,
    dimension: DataFrame,
    *,
    fact_key: str,
    dimension_key: str,
    group: str,
    timestamp: str,
    hour: str,
    count: str,
    k: int,
) -> DataFrame:
    """Rows per hour of day in the k largest groups, from a single pass over the facts.

    Every group is reduced to its total and one sum per hour (24 plus one for missing timestamps), so the top k can be
    cut with the hourly figures attached instead of joining the facts to the k groups in a second pass.
    """
    counter = count_rows(count)
    per_hour = joined_partials(
        facts,
        dimension,
        fact_key=fact_key,
        dimension_key=dimension_key,
        attributes=[group],
        measures=[counter],
        fact_groups={hour: F.hour(timestamp)},
    )
    rows = F.col(counter.partial_name())
    hours = [*range(24), None]

    def in_hour(value: int | None):
        return F.col(hour).isNull() if value is None else F.col(hour) == value

    profiles = per_hour.groupBy(group).agg(
        F.sum(rows).alias("__total"),
        *[F.sum(F.when(in_hour(h), rows)).alias(f"__h{i}") for i, h in enumerate(hours)],
    )
    largest = profiles.orderBy(F.desc("__total"), group).limit(k)
    unpacked = F.inline(
        F.array(
            *[
                F.struct(F.lit(h).cast("int").alias(hour), F.col(f"__h{i}").alias(count))
                for i, h in enumerate(hours)
            ]
        )
    )
    # A null group may take one of the k places, but it never equals anything in a join and so has no detail rows.
    return (
        largest.where(F.col(group).isNotNull())
        .select(group, unpacked)
        .where(F.col(count).isNotNull())
        .orderBy(group, F.desc(count), hour)
    )
