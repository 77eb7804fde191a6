import os

import pytest
from result_helpers import final_plan, rows
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fareloom.plans.tables import DIM_LOCATION, DIM_PLATFORM, LOCATION_FILE
from fareloom.session import discard_at_exit, materialise, scratch_path
from fareloom.sources import catalog
from fareloom.sources.periods import Period, period_scan
from fareloom.sources.publishing import balanced, compact_export, publish, stage, staged_partitions, staged_table
from fareloom.sources.tables import csv_table, parquet_table, register, rows_table, sql_table

CONTRACT = StructType().add("id", "long").add("year", "string").add("month", "string").add("day", "string")


def dated(spark, *items):
    return spark.createDataFrame([(i, *day.split("-")) for i, day in items], CONTRACT)


def directories(path):
    return sorted(
        os.path.relpath(base, path) for base, _, files in os.walk(path) if any(f.endswith(".parquet") for f in files)
    )


@pytest.mark.parametrize("text", ["2024-6", "2024-13", "2024-00", "24-06", "2024-06-01", "2024/06", "", "2024-06\n"])
def test_bad_periods_are_refused(text):
    with pytest.raises(ValueError):
        Period.parse(text)


def test_period_text():
    period = Period.parse("2024-06")
    assert (period.year, period.month, period.directory, str(period)) == (
        "2024",
        "06",
        "year=2024/month=06",
        "2024-06",
    )


@pytest.mark.parametrize("inference", ["true", "false"])
def test_period_scan_reads_one_month(spark, tmp_path, inference):
    base = str(tmp_path / "raw")
    history = dated(spark, (1, "2024-06-01"), (2, "2024-06-30"), (3, "2024-07-01"), (4, "2023-06-01"))
    stage(history, base, ("year", "month"))
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", inference)
    try:
        scan = period_scan(spark, base + "/", Period.parse("2024-06"))
        assert scan.columns == ["id", "day"]
        assert sorted(rows(scan)) == [(1, "01"), (2, "30")]
        plan = final_plan(scan)
        assert "PartitionFilters: [isnotnull(year" in plan
        leaf = spark.read.parquet(f"{base}/year=2024/month=06/")
        assert scan.columns == leaf.columns and sorted(rows(scan)) == sorted(rows(leaf))
    finally:
        spark.conf.unset("spark.sql.sources.partitionColumnTypeInference.enabled")


def test_period_scan_of_a_missing_month_fails(spark, tmp_path):
    base = str(tmp_path / "raw")
    stage(dated(spark, (1, "2024-06-01")), base, ("year", "month"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        period_scan(spark, base, Period.parse("2024-07"))


def test_staging_overwrites_everything_and_reads_back_as_text(spark, tmp_path):
    path = str(tmp_path / "staging")
    stage(dated(spark, (1, "2024-06-01"), (2, "2024-06-02")), path)
    stage(dated(spark, (3, "2024-06-02")), path)
    assert directories(path) == ["year=2024/month=06/day=02"]
    back = staged_table(spark, path, CONTRACT)
    assert rows(back) == [(3, "2024", "06", "02")]
    assert [kind for _, kind in back.dtypes] == ["bigint", "string", "string", "string"]


def test_staging_replaces_all_even_under_dynamic_overwrite(spark, tmp_path):
    path = str(tmp_path / "staging")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        stage(dated(spark, (1, "2024-06-01")), path)
        stage(dated(spark, (2, "2024-06-02")), path)
        assert directories(path) == ["year=2024/month=06/day=02"]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_file_record_cap(spark, tmp_path):
    path = str(tmp_path / "capped")
    stage(spark.range(100).select("id", F.lit("2024").alias("year")), path, ("year",), max_records_per_file=30)
    files = [f for f in os.listdir(path + "/year=2024") if f.endswith(".parquet")]
    assert len(files) >= 4
    assert max(spark.read.parquet(f"{path}/year=2024/{f}").count() for f in files) <= 30


def test_a_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    """One day holds nearly all rows; the rebalance splits it instead of handing it to one task."""
    path = str(tmp_path / "hot")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(0, 200000, 1, 8).select(
            "id",
            F.xxhash64("id").alias("noise"),
            F.when(F.col("id") % 50 == 0, "02").otherwise("01").alias("day"),
        )
        stage(df, path, ("day",))
        files = [f for f in os.listdir(path + "/day=01") if f.endswith(".parquet")]
        assert len(files) > 4
        assert spark.read.parquet(path).count() == 200000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_without_adaptive_execution_rows_are_not_gathered(spark, tmp_path):
    df = dated(spark, (1, "2024-06-01"))
    assert "rebalance" in balanced(df, ["day"])._jdf.queryExecution().logical().toString().lower()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert balanced(df, ["day"]) is df
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_staged_partitions(spark):
    df = dated(spark, (1, "2024-06-01"), (2, "2024-06-01"), (3, "2024-07-02"))
    assert sorted(rows(staged_partitions(df))) == [("2024", "06", "01"), ("2024", "07", "02")]


@pytest.fixture
def main_and_staging(spark, tmp_path):
    main, staging = str(tmp_path / "main"), str(tmp_path / "staging")
    stage(dated(spark, (1, "2024-05-31"), (2, "2024-06-01"), (3, "2024-06-02")), main)
    stage(dated(spark, (20, "2024-06-01"), (30, "2024-06-03"), (10, "2024-05-31")), staging)
    return main, staging


def test_publish_replaces_only_the_period(spark, main_and_staging):
    main, staging = main_and_staging
    for _ in range(2):
        publish(spark, staging, main, CONTRACT, period=Period.parse("2024-06"))
        assert sorted(rows(staged_table(spark, main, CONTRACT).select("id", "month", "day"))) == [
            (1, "05", "31"),
            (3, "06", "02"),
            (20, "06", "01"),
            (30, "06", "03"),
        ]


def test_publish_without_period_replaces_every_staged_partition(spark, main_and_staging):
    main, staging = main_and_staging
    publish(spark, staging, main, CONTRACT)
    assert sorted(row[0] for row in rows(staged_table(spark, main, CONTRACT))) == [3, 10, 20, 30]


def test_publish_to_a_new_main_path(spark, main_and_staging, tmp_path):
    publish(spark, main_and_staging[1], str(tmp_path / "new"), CONTRACT, period=Period.parse("2024-06"))
    assert directories(str(tmp_path / "new")) == ["year=2024/month=06/day=01", "year=2024/month=06/day=03"]


def test_publish_onto_itself_is_refused(spark, main_and_staging):
    with pytest.raises(ValueError):
        publish(spark, main_and_staging[0], main_and_staging[0] + "/", CONTRACT)


def test_a_failing_publish_leaves_main_as_it_was(spark, main_and_staging):
    main, staging = main_and_staging
    before = sorted(rows(staged_table(spark, main, CONTRACT)))
    broken = os.path.join(staging, "year=2024/month=06/day=03")
    target = next(f for f in os.listdir(broken) if f.endswith(".parquet"))
    with open(os.path.join(broken, target), "wb") as handle:
        handle.write(b"not parquet")
    with pytest.raises(Exception):
        publish(spark, staging, main, CONTRACT, period=Period.parse("2024-06"))
    assert sorted(rows(staged_table(spark, main, CONTRACT))) == before


def test_compact_export_writes_the_wanted_number_of_files(spark, tmp_path):
    path = str(tmp_path / "out")
    for expected in (1, 2):
        compact_export(spark.range(0, 100, 1, 8), path, expected)
        assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == expected
        assert spark.read.parquet(path).count() == 100


CSV = 'LocationID,Borough,Zone,service_zone\n1,Queens,"A, ""B"" zone",N/A\n264,Unknown,N/A,N/A\n'


@pytest.fixture
def csv_path(tmp_path):
    (tmp_path / "dim").mkdir()
    (tmp_path / "dim" / "locations.csv").write_text(CSV)
    return str(tmp_path / "dim")


@pytest.mark.parametrize("schema", [None, LOCATION_FILE])
def test_csv_scan(spark, csv_path, schema):
    df = csv_table(spark, csv_path, schema)
    assert df.dtypes[0] == ("LocationID", "int")
    assert rows(df) == [(1, "Queens", 'A, "B" zone', "N/A"), (264, "Unknown", "N/A", "N/A")]
    assert df.select("borough", "zone").count() == 2


def test_csv_catalog_table_binds_by_position(spark, csv_path):
    catalog.create_csv_table(spark, "dim_location_test", DIM_LOCATION, csv_path)
    catalog.create_csv_table(spark, "dim_location_test", DIM_LOCATION, csv_path)
    df = spark.table("dim_location_test")
    assert df.columns == ["location_id", "borough", "zone", "service_zone"]
    assert rows(df)[0] == (1, "Queens", 'A, "B" zone', "N/A")
    assert DIM_PLATFORM.fieldNames() == ["platform_key", "platform_name"]


def test_fact_table_in_the_catalog(spark, tmp_path):
    path = str(tmp_path / "it's facts")
    stage(dated(spark, (2, "2024-06-10"), (1, "2024-06-10"), (3, "2024-06-11")), path)
    catalog.create_fact_table(spark, "facts_test", CONTRACT, ("year", "month", "day"), path)
    assert spark.table("facts_test").count() == 0
    day = {"year": "2024", "month": "06", "day": "10"}
    location = f"{path}/year=2024/month=06/day=10"
    for _ in range(2):
        catalog.add_partition(spark, "facts_test", day, location)
    assert spark.table("facts_test").count() == 2
    catalog.recover_partitions(spark, "facts_test")
    assert spark.table("facts_test").count() == 3
    peek = catalog.partition_rows(spark, "facts_test", day, limit=1, order_by=["id"])
    assert rows(peek) == [(1, "2024", "06", "10")]
    assert "PartitionFilters: [isnotnull(year" in final_plan(catalog.partition_rows(spark, "facts_test", day))
    assert catalog.partition_rows(spark, "facts_test", day, limit=100).count() == 2


def test_views_rows_and_sql(spark, tmp_path):
    df = rows_table(spark, [(1, "a"), (2, "b")], ["id", "name"])
    register(df, "named_rows")
    assert rows(sql_table(spark, "SELECT name FROM named_rows WHERE id = 2")) == [("b",)]
    assert rows(sql_table(spark, "SELECT count(*) FROM {left} JOIN {right} USING (id)", left=df, right=df)) == [(2,)]
    df.write.parquet(str(tmp_path / "p"))
    assert parquet_table(spark, str(tmp_path / "p")).count() == 2
    assert parquet_table(spark, str(tmp_path / "p"), StructType().add("id", "long")).columns == ["id"]


def test_scratch_lies_below_the_shared_folder(spark):
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two
    assert one.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_materialised_table_is_written_once(spark):
    df = materialise(spark.range(5).withColumn("r", F.rand()), "five")
    assert rows(df) == rows(df)
    assert "FileScan parquet" in final_plan(df)
    discard_at_exit(spark, df.inputFiles()[0])
