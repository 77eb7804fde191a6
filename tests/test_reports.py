import pytest
from result_helpers import final_plan, rows
from pyspark.sql import functions as F

from fareloom.operators.rollup import Measure, count_rows, mean, rollup_by_dimension, total
from fareloom.operators.topgroups import top_groups
from fareloom.plans import reports


@pytest.fixture(scope="module")
def trips(make_trips):
    return make_trips(
        [
            ("2024-05-01 08:00:00", "2024-05-01 08:30:00", 3.0, 20.0, {"pu": 1, "do": 1, "tip": 2.0}),
            ("2024-05-02 08:10:00", "2024-05-02 08:30:00", 3.0, 10.0, {"pu": 2, "do": 3, "tip": 2.0}),
            ("2024-05-03 09:00:00", "2024-05-03 09:30:00", 2.0, 40.0, {"pu": 3, "do": 2, "tip": 4.0}),
            ("2024-05-06 23:50:00", "2024-05-07 00:00:00", 4.0, 30.0, {"pu": 3, "do": 3, "tip": 0.0}),
            ("2024-05-06 23:50:00", "2024-05-07 00:00:01", 4.0, 99.0, {"pu": 3, "do": 3, "tip": -1.0}),
            ("2024-05-04 10:00:00", "2024-05-04 10:05:00", 4.0, 0.0, {"pu": 1, "do": 1}),
            ("2024-05-04 10:00:00", "2024-05-04 10:05:00", 4.0, 7.0, {"pu": 500, "do": 500}),
            (None, "2024-05-04 10:05:00", 4.0, 8.0, {"pu": 264, "do": 264, "tip": 2.0}),
        ]
    )


def test_revenue_by_borough(trips, locations):
    result = reports.revenue_by_borough(trips, locations, "2024-05-01", "2024-05-07")
    assert result.columns == ["borough", "total_trips", "total_revenue"]
    assert rows(result) == [("Queens", 2, 60.0), ("Bronx", 2, 40.0), ("Unknown", 1, 8.0)]


def test_hourly_trend_merges_zone_ids_and_breaks_ties_by_name(trips, locations):
    result = reports.hourly_trend_of_top_zones(trips, locations, k=2)
    assert result.columns == ["zone", "pickup_hour", "trips_during_hour"]
    assert rows(result) == [("Belmont", 23, 2), ("Belmont", 9, 1), ("Corona", 8, 2), ("Corona", 10, 1)]


def test_missing_pickup_time_is_an_hour_of_its_own(trips, locations):
    result = reports.hourly_trend_of_top_zones(trips, locations)
    assert ("N/A", None, 1) in rows(result)


def test_a_null_group_takes_a_place_but_shows_no_rows(spark, trips, locations):
    nameless = locations.withColumn("Zone", F.when(F.col("LocationID") != 3, F.col("Zone")))
    assert rows(reports.hourly_trend_of_top_zones(trips, nameless, k=1)) == []
    two = reports.hourly_trend_of_top_zones(trips, nameless, k=2)
    assert rows(two) == [("Corona", 8, 2), ("Corona", 10, 1)]
    assert rows(reports.hourly_trend_of_top_groups_sql(
        spark, trips, nameless, reports.PICKUP_ZONE, timestamp="lpep_pickup_datetime", k=2
    )) == rows(two)


def test_mean_tip_percent(trips, locations):
    result = reports.mean_tip_percent_by_borough(trips, locations)
    assert result.columns == ["borough", "avg_tip_percentage"]
    assert rows(result) == [("Unknown", 25.0), ("Queens", 15.0), ("Bronx", 0.0)]


@pytest.mark.parametrize(
    "frame, text, options",
    [
        (
            reports.revenue_by_group,
            reports.revenue_by_group_sql,
            dict(timestamp="lpep_dropoff_datetime", first="2024-05-01", last="2024-05-07", amount="total_amount"),
        ),
        (
            reports.hourly_trend_of_top_groups,
            reports.hourly_trend_of_top_groups_sql,
            dict(timestamp="lpep_pickup_datetime", k=2),
        ),
        (
            reports.mean_percent_by_group,
            reports.mean_percent_by_group_sql,
            dict(distance="trip_distance", part="tip_amount", whole="total_amount"),
        ),
        (reports.counts_by_label, reports.counts_by_label_sql, {}),
    ],
)
def test_sql_twins_agree(spark, trips, locations, frame, text, options):
    for star in (reports.PICKUP_BOROUGH, reports.PICKUP_ZONE):
        left, right = frame(trips, locations, star, **options), text(spark, trips, locations, star, **options)
        assert left.columns == right.columns
        assert sorted(rows(left), key=str) == sorted(rows(right), key=str)


def test_bookings_by_platform_keeps_unmatched_keys(spark):
    facts = spark.createDataFrame(
        [("HV0003", "2024", "06", "10"), ("HV0003", "2024", "06", "10"), ("2", "2024", "06", "10"),
         (None, "2024", "06", "10"), ("HV0003", "2024", "06", "11")],
        "platform_key string, year string, month string, day string",
    )
    platforms = spark.createDataFrame(
        [("HV0003", "Uber"), ("HV0005", "Lyft")], "platform_key string, platform_name string"
    )
    result = reports.bookings_by_platform(facts, platforms, "2024", "06", "10")
    assert sorted(rows(result), key=str) == [("Uber", 2), (None, 2)]


def test_rollup_equals_join_then_group_with_repeated_dimension_keys(spark):
    facts = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).cast("int").alias("k"),
        F.col("id").alias("v"),
    )
    dimension = spark.createDataFrame(
        [(i, f"g{i % 7}") for i in range(40)] + [(1, "again")], "dk int, g string"
    )
    result = rollup_by_dimension(
        facts,
        dimension,
        fact_key="k",
        dimension_key="dk",
        group_by=["g"],
        measures=[count_rows("n"), total("s", F.col("v")), mean("m", F.col("v").cast("double"))],
    )
    naive = (
        facts.join(dimension, F.col("k") == F.col("dk"))
        .groupBy("g")
        .agg(F.count("*").alias("n"), F.sum("v").alias("s"), F.avg("v").alias("m"))
    )
    assert sorted(rows(result)) == sorted(rows(naive))


def test_mean_ignores_nulls_and_unknown_kinds_are_refused(spark, locations):
    facts = spark.createDataFrame([(1, 2.0), (1, None), (2, 4.0), (3, None)], "k int, v double")
    result = rollup_by_dimension(
        facts,
        locations,
        fact_key="k",
        dimension_key="LocationID",
        group_by=["Borough"],
        measures=[mean("m", F.col("v"))],
    )
    assert sorted(rows(result)) == [("Bronx", None), ("Queens", 3.0)]
    with pytest.raises(ValueError):
        Measure("x", "median", F.lit(1)).partials()


def test_top_groups_break_ties_by_name(trips, locations):
    result = top_groups(
        trips, locations, fact_key="PULocationID", dimension_key="LocationID", group="Zone", k=1, count="trips"
    )
    assert rows(result) == [("Belmont", 3)]


def test_a_hot_key_is_combined_before_the_shuffle(spark, tmp_path):
    """A third of the rows on one key: after the map side, the shuffle carries a handful of rows per task."""
    facts = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 200).cast("int").alias("k")
    )
    facts.write.parquet(str(tmp_path / "facts"))
    dimension = spark.createDataFrame([(i, f"g{i % 5}") for i in range(200)], "dk int, g string")
    result = rollup_by_dimension(
        spark.read.parquet(str(tmp_path / "facts")),
        dimension,
        fact_key="k",
        dimension_key="dk",
        group_by=["g"],
        measures=[count_rows("n")],
    )
    plan = final_plan(result)
    aggregate, join = plan.index("partial_count"), plan.index("Join")
    assert join < aggregate, "the partial count lies below the join"
    assert sum(row[1] for row in rows(result)) == 30000


def test_hourly_trend_scans_the_facts_once(spark, tmp_path, trips, locations):
    trips.write.parquet(str(tmp_path / "trips"))
    stored = spark.read.parquet(str(tmp_path / "trips"))
    plan = final_plan(reports.hourly_trend_of_top_zones(stored, locations))
    assert plan.count("FileScan parquet") == 1
    assert "TakeOrderedAndProject" in plan
    assert "ReadSchema: struct<lpep_pickup_datetime:timestamp_ntz,PULocationID:int>" in plan


def test_filters_reach_the_scan(spark, tmp_path, trips, locations):
    trips.write.parquet(str(tmp_path / "trips"))
    stored = spark.read.parquet(str(tmp_path / "trips"))
    plan = final_plan(reports.revenue_by_borough(stored, locations, "2024-05-01", "2024-05-07"))
    assert "GreaterThan(total_amount,0.0)" in plan
    assert "ReadSchema: struct<lpep_dropoff_datetime:timestamp_ntz,DOLocationID:int,total_amount:double>" in plan
