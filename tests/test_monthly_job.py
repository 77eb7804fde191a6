import os
import sys
from dataclasses import replace

import pytest
from result_helpers import final_plan, rows
from pyspark.sql import functions as F

from fareloom.operators.quality import QualityError
from fareloom.plans import monthly_job
from fareloom.plans.dialects import GREEN
from fareloom.plans.reports import bookings_by_platform, bookings_by_platform_sql
from fareloom.plans.tables import FACT_BOOKINGS
from fareloom.sources.publishing import staged_table


@pytest.fixture
def lake(tmp_path, make_rates):
    paths = monthly_job.JobPaths(*[str(tmp_path / n) for n in ("bookings", "rates", "staging", "facts", "rejects")])
    make_rates([("USD", "GBP", "2024-06-01", 0.8), ("USD", "EUR", "2024-06-01", 0.9)]).write.parquet(
        f"{paths.rates}/year=2024/month=06"
    )
    return paths


def put(make_trips, paths, rows, month="06"):
    make_trips(rows).write.mode("overwrite").parquet(f"{paths.bookings}/year=2024/month={month}")


def published(spark, paths):
    return sorted(
        rows(staged_table(spark, paths.facts, FACT_BOOKINGS).select("month", "day", "total_fare", "total_fare_gbp"))
    )


GOOD = [
    ("2024-06-01 10:00:00", "2024-06-01 10:30:00", 5.0, 20.0),
    ("2024-06-02 10:00:00", "2024-06-02 10:30:00", 5.0, 30.0),
]


def test_a_month_is_published(spark, make_trips, lake):
    put(make_trips, lake, GOOD)
    result = monthly_job.run(spark, "2024-06", GREEN, lake)
    assert published(spark, lake) == [("06", "01", 20.0, 16.0), ("06", "02", 30.0, None)]
    assert result.stray_rows == 0
    assert all(row.violations == 0 for row in result.checks)
    assert {finding.kind for finding in result.findings} == {"nullability_mismatches"}
    assert len(result.findings) == 20
    assert os.path.isdir(f"{lake.facts}/year=2024/month=06/day=01")


def test_running_again_gives_the_same_table(spark, make_trips, lake):
    put(make_trips, lake, GOOD)
    monthly_job.run(spark, "2024-06", GREEN, lake)
    before = published(spark, lake)
    monthly_job.run(spark, "2024-06", GREEN, lake)
    assert published(spark, lake) == before


def test_corrected_days_replace_published_ones(spark, make_trips, lake):
    put(make_trips, lake, GOOD)
    monthly_job.run(spark, "2024-06", GREEN, lake)
    put(make_trips, lake, [("2024-06-02 11:00:00", "2024-06-02 11:30:00", 5.0, 35.0)])
    monthly_job.run(spark, "2024-06", GREEN, lake)
    assert published(spark, lake) == [("06", "01", 20.0, 16.0), ("06", "02", 35.0, None)]


def test_stray_days_do_not_replace_other_months(spark, make_trips, make_rates, lake):
    make_rates([("USD", "GBP", "2024-05-31", 0.5)]).write.parquet(f"{lake.rates}/year=2024/month=05")
    put(make_trips, lake, [("2024-05-31 09:00:00", "2024-05-31 09:30:00", 5.0, 99.0)], month="05")
    monthly_job.run(spark, "2024-05", GREEN, lake)
    put(make_trips, lake, [*GOOD, ("2024-05-31 23:50:00", "2024-06-01 00:10:00", 5.0, 10.0)])
    result = monthly_job.run(spark, "2024-06", GREEN, lake)
    assert result.stray_rows == 1
    assert published(spark, lake)[0] == ("05", "31", 99.0, 49.5)
    assert len(published(spark, lake)) == 3
    rejected = spark.read.parquet(f"{lake.rejects}/dialect=green/period=2024-06")
    assert [row.total_fare for row in rejected.collect()] == [10.0]


@pytest.mark.parametrize(
    "bad",
    [
        ("2024-06-01 10:30:00", "2024-06-01 10:00:00", 5.0, 10.0),
        ("2024-06-01 10:00:00", "2024-06-01 10:30:00", 5.0, 10000.01),
        (None, "2024-06-01 10:30:00", 5.0, 10.0),
    ],
)
def test_failed_checks_leave_the_table_alone(spark, make_trips, lake, bad):
    put(make_trips, lake, GOOD)
    monthly_job.run(spark, "2024-06", GREEN, lake)
    before = published(spark, lake)
    put(make_trips, lake, [*GOOD, bad])
    with pytest.raises(QualityError):
        monthly_job.run(spark, "2024-06", GREEN, lake)
    assert published(spark, lake) == before


def test_duplicate_rates_stop_the_job(spark, make_trips, make_rates, lake):
    put(make_trips, lake, GOOD)
    make_rates([("USD", "GBP", "2024-06-01", 0.7)]).write.mode("append").parquet(f"{lake.rates}/year=2024/month=06")
    with pytest.raises(Exception, match="more than one GBP rate"):
        monthly_job.run(spark, "2024-06", GREEN, lake)
    assert not os.path.exists(lake.facts)


def test_strays_without_a_place_for_them_stop_the_job(spark, make_trips, lake):
    lake = replace(lake, rejects=None)
    put(make_trips, lake, [*GOOD, ("2024-05-31 23:50:00", "2024-06-01 00:10:00", 5.0, 10.0)])
    with pytest.raises(monthly_job.StrayRowsError, match="1 rows are outside 2024-06"):
        monthly_job.run(spark, "2024-06", GREEN, lake)
    assert not os.path.exists(lake.facts)


def files_below(path):
    return sorted((str(p.relative_to(path)), p.stat().st_mtime_ns) for p in path.rglob("*") if p.is_file())


@pytest.mark.parametrize("first", range(5))
@pytest.mark.parametrize("spelling", ["{}", "{}/", "{}//", "file:{}", "file://{}/.", "{}/inner", "{}/../{name}"])
def test_equal_or_nested_paths_change_nothing(spark, make_trips, lake, tmp_path, first, spelling):
    put(make_trips, lake, GOOD)
    before = files_below(tmp_path)
    names = ["bookings", "rates", "staging", "facts", "rejects"]
    one, other = names[first], names[(first + 2) % 5]
    path = getattr(lake, one)
    with pytest.raises(ValueError, match="equal or nested"):
        broken = replace(lake, **{other: spelling.format(path, name=os.path.basename(path))})
        monthly_job.run(spark, "2024-06", GREEN, broken)
    assert files_below(tmp_path) == before


def test_staging_refuses_data_of_other_origin(spark, make_trips, lake):
    put(make_trips, lake, GOOD)
    taken = lake.staging_of(GREEN, monthly_job.Period.parse("2024-06"))
    spark.range(3).write.parquet(taken)
    with pytest.raises(ValueError, match="no staging area"):
        monthly_job.run(spark, "2024-06", GREEN, lake)
    assert spark.read.parquet(taken).count() == 3


def test_months_staged_side_by_side_do_not_meet(spark, make_trips, make_rates, lake):
    make_rates([("USD", "GBP", "2024-05-31", 0.5)]).write.parquet(f"{lake.rates}/year=2024/month=05")
    put(make_trips, lake, [("2024-05-31 09:00:00", "2024-05-31 09:30:00", 5.0, 99.0)], month="05")
    put(make_trips, lake, GOOD)
    periods = [monthly_job.Period.parse(text) for text in ("2024-05", "2024-06")]
    staged = [monthly_job.transform(spark, period, GREEN, lake) for period in periods]
    for month, period in zip(reversed(staged), reversed(periods)):
        monthly_job.load(spark, month, period, GREEN, lake)
    assert [row[:2] for row in published(spark, lake)] == [("05", "31"), ("06", "01"), ("06", "02")]


def test_checks_are_counted_while_staging(spark, make_trips, lake):
    """The month is read raw once and staging once, for the copy: no scan for the checks."""
    put(make_trips, lake, GOOD)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counting", "jobs of one load")
    staged = monthly_job.transform(spark, monthly_job.Period.parse("2024-06"), GREEN, lake)
    assert {row.check_name: row.violations for row in staged.checks}["null_check"] == 0
    before = len(tracker.getJobIdsForGroup("counting"))
    monthly_job.load(spark, staged, monthly_job.Period.parse("2024-06"), GREEN, lake)
    assert len(tracker.getJobIdsForGroup("counting")) - before <= 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_wrong_dialect_or_month_fails(spark, make_trips, lake):
    put(make_trips, lake, GOOD)
    with pytest.raises(Exception, match="hvfhs_license_num"):
        monthly_job.run(spark, "2024-06", monthly_job.DIALECTS["hvfhv"], lake)
    with pytest.raises(ValueError):
        monthly_job.run(spark, "June", GREEN, lake)


def test_wide_raw_files_are_read_narrow(spark, make_trips, lake):
    make_trips(GOOD).withColumn("unused", F.lit("x")).write.parquet(f"{lake.bookings}/year=2024/month=06")
    raw = monthly_job.period_scan(spark, lake.bookings, monthly_job.Period.parse("2024-06"))
    facts = monthly_job.fact_bookings(raw, spark.read.parquet(lake.rates), GREEN)
    schemas = [part.split("\n")[0] for part in final_plan(facts).split("ReadSchema: ")[1:]]
    assert any("trip_distance" in schema for schema in schemas)
    assert not any("unused" in schema for schema in schemas)


def test_a_hot_day_is_written_by_several_tasks(spark, make_trips, lake):
    """Nearly all bookings on one day, in a single shuffle of the raw columns."""
    trips = make_trips(GOOD).crossJoin(spark.range(0, 100000, 1, 8))
    noisy = trips.where("id % 50 = 0 OR lpep_pickup_datetime < '2024-06-02'").withColumn(
        "tip_amount", F.rand(7)
    )
    noisy.drop("id").repartition(8).write.parquet(f"{lake.bookings}/year=2024/month=06")
    small = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.files.maxPartitionBytes": "64k",
        "spark.sql.files.openCostInBytes": "1k",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        monthly_job.transform(spark, monthly_job.Period.parse("2024-06"), GREEN, lake)
    finally:
        for key in small:
            spark.conf.unset(key)
    days = {
        day: [f for f in os.listdir(f"{lake.staging}/green/2024-06/year=2024/month=06/day={day}") if f.endswith(".parquet")]
        for day in ("01", "02")
    }
    assert len(days["01"]) > 2
    assert staged_table(spark, f"{lake.staging}/green/2024-06", FACT_BOOKINGS).count() == 102000


def test_day_report_over_published_rows(spark, make_trips, lake):
    put(make_trips, lake, GOOD)
    monthly_job.run(spark, "2024-06", GREEN, lake)
    platforms = spark.createDataFrame([("HV0003", "x")], "platform_key string, platform_name string")
    facts = staged_table(spark, lake.facts, FACT_BOOKINGS)
    report = bookings_by_platform(facts, platforms, "2024", "06", "01")
    assert rows(report) == [(None, 1)]
    assert "PartitionFilters: [isnotnull" in final_plan(report)
    assert rows(bookings_by_platform_sql(spark, facts, platforms, "2024", "06", "01")) == [(None, 1)]


def test_command_line(spark, make_trips, lake, monkeypatch):
    put(make_trips, lake, GOOD)
    monkeypatch.setattr(monthly_job, "open_session", lambda name: spark)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    arguments = ["--date_str", "2024-06", "--dialect", "green"]
    for name in ("bookings", "rates", "staging", "facts", "rejects"):
        arguments += [f"--{name}", getattr(lake, name)]
    monthly_job.main([*arguments, "--max_records_per_file", "200000"])
    assert len(published(spark, lake)) == 2
    with pytest.raises(SystemExit):
        monthly_job.main(arguments[2:])
    assert "argparse" in sys.modules
