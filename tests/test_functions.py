import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from fareloom.functions import measures, temporal
from fareloom.functions.network import is_ipv4
from fareloom.functions.python_udfs import is_ipv4_udf, miles_per_minute_udf


def one(df):
    return df.first()[0]


def at(spark, text, kind="timestamp_ntz"):
    return spark.sql(f"SELECT CAST({repr(text) if text else 'NULL'} AS {kind}) AS ts")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_keys_of_a_moment(spark, kind):
    row = at(spark, "2024-06-01 09:05:59.9", kind).select(
        temporal.date_key("ts"),
        temporal.hour_key("ts"),
        temporal.date_text("ts"),
        temporal.hour_of_day("ts"),
        *temporal.partition_values("ts").values(),
    )
    assert tuple(row.first()) == (20240601, 2024060109, "2024-06-01", 9, "2024", "06", "01")
    assert [kind for _, kind in row.dtypes] == ["int", "int", "string", "int", "string", "string", "string"]


def test_keys_of_null_are_null(spark):
    row = at(spark, None).select(
        temporal.date_key("ts"), temporal.hour_key("ts"), *temporal.partition_values("ts").values()
    )
    assert tuple(row.first()) == (None,) * 5


def test_hour_key_outside_int_range_is_null(spark):
    assert one(at(spark, "2147-01-01 00:00:00").select(temporal.hour_key("ts"))) == 2147010100
    assert one(at(spark, "2148-01-01 00:00:00").select(temporal.hour_key("ts"))) is None


def test_keys_ignore_the_session_zone_for_ntz(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        frame = at(spark, "2024-03-10 02:30:00").select(temporal.hour_key("ts"), temporal.date_key("ts"))
        assert tuple(frame.first()) == (2024031002, 20240310)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_elapsed_seconds_drop_fractions_of_each_end(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-06-01 10:00:00.9' AS a, timestamp_ntz'2024-06-01 10:00:02.1' AS b")
    assert one(df.select(temporal.elapsed_seconds("a", "b"))) == 2.0
    assert one(df.select(temporal.elapsed_seconds("b", "a"))) == -2.0


@pytest.mark.parametrize(
    "miles, seconds, speed, efficiency",
    [
        (5.0, 1800.0, 10.0, 5 / 30),
        (5.0, 120.0, 150.0, None),
        (5.0, 121.0, 5 / (121 / 3600), 5 / (121 / 60)),
        (1.0, 1800.0, 2.0, None),
        (5.0, 0.0, None, None),
        (5.0, -1800.0, -10.0, None),
        (None, 1800.0, None, None),
        (5.0, None, None, None),
    ],
)
def test_speed_and_efficiency(spark, miles, seconds, speed, efficiency):
    df = spark.createDataFrame([(miles, seconds)], "m double, s double")
    row = df.select(
        measures.miles_per_hour("m", "s"),
        measures.miles_per_minute("m", "s"),
        miles_per_minute_udf()("m", "s"),
    ).first()
    assert row[0] == (None if speed is None else pytest.approx(speed))
    assert row[1] == (None if efficiency is None else pytest.approx(efficiency))
    assert row[2] == row[1]


def test_nan_distance_has_no_efficiency(spark):
    df = spark.createDataFrame([(math.nan, 1800.0), (5.0, math.nan)], "m double, s double")
    native, udf = measures.miles_per_minute("m", "s"), miles_per_minute_udf()("m", "s")
    assert [tuple(row) for row in df.select(native, udf).collect()] == [(None, None)] * 2


def test_total_with_a_null_part_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, None)], "a double, b double")
    assert [row[0] for row in df.select(measures.strict_total("a", "b", F.lit(0.5))).collect()] == [3.5, None]


def test_percent_of_zero_is_null(spark):
    df = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0)], "a double, b double")
    assert [row[0] for row in df.select(measures.percent_of("a", "b")).collect()] == [25.0, None]


FLAG_TEXTS = ["Y", "N", "y", "n", " ", "", None, "yes", "No", "TRUE", "f", "1", "0", "2", " Y\t", "\n n", "Y N", "é"]


def test_flags_follow_the_cast(spark):
    df = spark.createDataFrame([(text,) for text in FLAG_TEXTS], "f string")
    ours = [row[0] for row in df.select(measures.yes_no_flag("f")).collect()]
    assert ours == [row[0] for row in df.select(F.col("f").try_cast("boolean")).collect()]
    assert ours[:7] == [True, False, True, False, None, None, None]


ADDRESSES = {
    "8.8.4.4": True,
    "203.0.113.255": True,
    "203.0.113.256": False,
    "224.1000.0.1": False,
    "www.example.org": False,
    "00.000.0.0": True,
    "009.080.007.06": True,
    None: False,
    "": False,
    "1..1.1": False,
    "1.1.1": False,
    "1.1.1.1.": False,
    "1.1.1.1.1": False,
    " 1.1.1.1": False,
    "-1.1.1.1": False,
    "+1.1.1.1": False,
    "1.1.1.1\n": False,
    "00001.1.1.1": True,
    "0" * 6000 + "7.1.1.1": True,
    "9" * 6000 + ".1.1.1": False,
    "1.1.1.999": False,
    "١٢.1.1.1": True,
    "٠٠٠١.1.1.1": True,
    "٣٠٠.1.1.1": False,
    "\U0001d7cf.1.1.1": True,
    "².1.1.1": False,
}


def test_ipv4_rules_native_and_udf(spark):
    df = spark.createDataFrame([(text,) for text in ADDRESSES], "ip string")
    checked = df.select("ip", is_ipv4("ip"), is_ipv4_udf()("ip")).collect()
    assert {row[0]: row[1] for row in checked} == ADDRESSES
    assert {row[0]: row[2] for row in checked} == ADDRESSES


def test_native_expressions_stay_on_the_jvm(spark):
    df = spark.createDataFrame([("1.1.1.1", 5.0, 300.0)], "ip string, m double, s double").repartition(1)
    native = df.select(is_ipv4("ip"), measures.miles_per_minute("m", "s"))
    assert "Python" not in native._jdf.queryExecution().executedPlan().toString()
    wrapped = df.select(is_ipv4_udf()("ip"), miles_per_minute_udf()("m", "s"))
    plan = wrapped._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "BatchEvalPython" not in plan


def test_date_values_have_keys_too(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 29),)], "d date")
    assert one(df.select(temporal.date_key("d"))) == 20240229
