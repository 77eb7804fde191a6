"""Reports over trips and dimensions, each as a DataFrame plan and as SQL text with the same result.

The functions take column names, so that they run on any fact and dimension table; the presets at the end bind them to
street-hail trips and the location dimension.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.functions.measures import percent_of
from fareloom.operators.rollup import count_rows, mean, rollup_by_dimension, total
from fareloom.operators.topgroups import hourly_counts_of_top_groups
from fareloom.sources.tables import sql_table


@dataclass(frozen=True)
class Star:
    """Which fact column points to which dimension column, and the attribute to report by."""

    fact_key: str
    dimension_key: str
    group: str
    group_as: str | None = None

    @property
    def label(self) -> str:
        return self.group_as or self.group

    def dimension(self, dimension: DataFrame) -> DataFrame:
        return dimension.select(self.dimension_key, F.col(self.group).alias(self.label))


def revenue_by_group(
    facts: DataFrame,
    dimension: DataFrame,
    star: Star,
    *,
    timestamp: str,
    first: str,
    last: str,
    amount: str,
    amount_type: str = "double",
) -> DataFrame:
    """Trips and revenue by group for positive amounts in a range of timestamps, best revenue first.

    Both bounds are inclusive points in time: a last bound given as a bare date keeps only that day's midnight. A
    decimal ``amount_type`` makes the sum independent of the order of addition.
    """
    kept = facts.where(F.col(timestamp).between(first, last) & (F.col(amount) > 0))
    grouped = rollup_by_dimension(
        kept,
        star.dimension(dimension),
        fact_key=star.fact_key,
        dimension_key=star.dimension_key,
        group_by=[star.label],
        measures=[
            count_rows("total_trips"),
            total("total_revenue", F.col(amount).cast(amount_type), cast="double"),
        ],
    )
    return grouped.orderBy(F.desc("total_revenue"), star.label)


def revenue_by_group_sql(
    spark: SparkSession,
    facts: DataFrame,
    dimension: DataFrame,
    star: Star,
    *,
    timestamp: str,
    first: str,
    last: str,
    amount: str,
    amount_type: str = "double",
) -> DataFrame:
    return sql_table(
        spark,
        f"""
        WITH per_key AS (
          SELECT {star.fact_key} AS fact_key, count(*) AS trips, sum(CAST({amount} AS {amount_type})) AS revenue
          FROM {{facts}}
          WHERE {timestamp} BETWEEN '{first}' AND '{last}' AND {amount} > 0
          GROUP BY {star.fact_key}
        )
        SELECT d.{star.group} AS {star.label},
               sum(p.trips) AS total_trips,
               CAST(sum(p.revenue) AS double) AS total_revenue
        FROM per_key p JOIN {{dimension}} d ON p.fact_key = d.{star.dimension_key}
        GROUP BY d.{star.group}
        ORDER BY total_revenue DESC, {star.label}
        """,
        facts=facts,
        dimension=dimension,
    )


def hourly_trend_of_top_groups(
    facts: DataFrame, dimension: DataFrame, star: Star, *, timestamp: str, k: int = 5
) -> DataFrame:
    """Trips by hour of day in the k groups with the most trips."""
    return hourly_counts_of_top_groups(
        facts,
        star.dimension(dimension),
        fact_key=star.fact_key,
        dimension_key=star.dimension_key,
        group=star.label,
        timestamp=timestamp,
        hour="pickup_hour",
        count="trips_during_hour",
        k=k,
    )


def hourly_trend_of_top_groups_sql(
    spark: SparkSession, facts: DataFrame, dimension: DataFrame, star: Star, *, timestamp: str, k: int = 5
) -> DataFrame:
    return sql_table(
        spark,
        f"""
        WITH per_key AS (
          SELECT {star.fact_key} AS fact_key, hour({timestamp}) AS pickup_hour, count(*) AS trips
          FROM {{facts}}
          GROUP BY {star.fact_key}, hour({timestamp})
        ), per_group AS (
          SELECT d.{star.group} AS grp, p.pickup_hour, sum(p.trips) AS trips
          FROM per_key p JOIN {{dimension}} d ON p.fact_key = d.{star.dimension_key}
          GROUP BY d.{star.group}, p.pickup_hour
        ), largest AS (
          -- at most 25 entries per group: one per hour and one for missing timestamps
          SELECT grp, sum(trips) AS trip_count, collect_list(struct(pickup_hour, trips)) AS hours
          FROM per_group GROUP BY grp ORDER BY trip_count DESC, grp LIMIT {k}
        )
        SELECT grp AS {star.label}, h.pickup_hour, h.trips AS trips_during_hour
        FROM largest LATERAL VIEW inline(hours) h AS pickup_hour, trips
        WHERE grp IS NOT NULL
        ORDER BY {star.label}, trips_during_hour DESC, pickup_hour
        """,
        facts=facts,
        dimension=dimension,
    )


def mean_percent_by_group(
    facts: DataFrame,
    dimension: DataFrame,
    star: Star,
    *,
    distance: str,
    part: str,
    whole: str,
    more_than: float = 2,
    result: str = "avg_tip_percentage",
) -> DataFrame:
    """Mean of per-row percentages by group, for rows over a distance with a positive whole and no negative part."""
    kept = facts.where((F.col(distance) > more_than) & (F.col(whole) > 0) & (F.col(part) >= 0))
    grouped = rollup_by_dimension(
        kept,
        star.dimension(dimension),
        fact_key=star.fact_key,
        dimension_key=star.dimension_key,
        group_by=[star.label],
        measures=[mean(result, percent_of(part, whole))],
    )
    return grouped.orderBy(F.desc(result), star.label)


def mean_percent_by_group_sql(
    spark: SparkSession,
    facts: DataFrame,
    dimension: DataFrame,
    star: Star,
    *,
    distance: str,
    part: str,
    whole: str,
    more_than: float = 2,
    result: str = "avg_tip_percentage",
) -> DataFrame:
    ratio = f"try_divide({part}, {whole}) * 100"
    return sql_table(
        spark,
        f"""
        WITH per_key AS (
          SELECT {star.fact_key} AS fact_key, sum({ratio}) AS ratio_sum, count({ratio}) AS ratio_count
          FROM {{facts}}
          WHERE {distance} > {more_than} AND {whole} > 0 AND {part} >= 0
          GROUP BY {star.fact_key}
        )
        SELECT d.{star.group} AS {star.label}, try_divide(sum(p.ratio_sum), sum(p.ratio_count)) AS {result}
        FROM per_key p JOIN {{dimension}} d ON p.fact_key = d.{star.dimension_key}
        GROUP BY d.{star.group}
        ORDER BY {result} DESC, {star.label}
        """,
        facts=facts,
        dimension=dimension,
    )


def counts_by_label(facts: DataFrame, dimension: DataFrame, star: Star, *, count: str = "bookings") -> DataFrame:
    """Row counts by dimension label; facts without a dimension row are counted under a null label."""
    return rollup_by_dimension(
        facts,
        star.dimension(dimension),
        fact_key=star.fact_key,
        dimension_key=star.dimension_key,
        group_by=[star.label],
        measures=[count_rows(count)],
        how="left",
    )


def counts_by_label_sql(
    spark: SparkSession, facts: DataFrame, dimension: DataFrame, star: Star, *, count: str = "bookings"
) -> DataFrame:
    return sql_table(
        spark,
        f"""
        WITH per_key AS (
          SELECT {star.fact_key} AS fact_key, count(1) AS rows FROM {{facts}} GROUP BY 1
        )
        SELECT d.{star.group} AS {star.label}, sum(p.rows) AS {count}
        FROM per_key p LEFT JOIN {{dimension}} d ON p.fact_key = d.{star.dimension_key}
        GROUP BY 1
        """,
        facts=facts,
        dimension=dimension,
    )


# The stars of the street-hail reports and of the booking fact table.
DROPOFF_BOROUGH = Star("DOLocationID", "LocationID", "Borough", "borough")
PICKUP_BOROUGH = Star("PULocationID", "LocationID", "Borough", "borough")
PICKUP_ZONE = Star("PULocationID", "LocationID", "Zone", "zone")
PLATFORM_NAME = Star("platform_key", "platform_key", "platform_name")


def revenue_by_borough(trips: DataFrame, locations: DataFrame, first: str, last: str) -> DataFrame:
    return revenue_by_group(
        trips,
        locations,
        DROPOFF_BOROUGH,
        timestamp="lpep_dropoff_datetime",
        first=first,
        last=last,
        amount="total_amount",
    )


def hourly_trend_of_top_zones(trips: DataFrame, locations: DataFrame, k: int = 5) -> DataFrame:
    return hourly_trend_of_top_groups(trips, locations, PICKUP_ZONE, timestamp="lpep_pickup_datetime", k=k)


def mean_tip_percent_by_borough(trips: DataFrame, locations: DataFrame) -> DataFrame:
    return mean_percent_by_group(
        trips, locations, PICKUP_BOROUGH, distance="trip_distance", part="tip_amount", whole="total_amount"
    )


def bookings_by_platform(facts: DataFrame, platforms: DataFrame, year: str, month: str, day: str) -> DataFrame:
    """Bookings of one day by platform name; the day is a partition filter."""
    rows = facts.where((F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day))
    return counts_by_label(rows, platforms, PLATFORM_NAME)


def bookings_by_platform_sql(
    spark: SparkSession, facts: DataFrame, platforms: DataFrame, year: str, month: str, day: str
) -> DataFrame:
    return sql_table(
        spark,
        """
        WITH of_day AS (
          SELECT platform_key, count(1) AS rows FROM {facts}
          WHERE year = {year} AND month = {month} AND day = {day} GROUP BY platform_key
        )
        SELECT p.platform_name, sum(d.rows) AS bookings
        FROM of_day d LEFT JOIN {platforms} p ON d.platform_key = p.platform_key
        GROUP BY p.platform_name
        """,
        facts=facts,
        platforms=platforms,
        year=year,
        month=month,
        day=day,
    )
