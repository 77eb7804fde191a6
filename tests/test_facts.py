import datetime as dt

import pytest
from result_helpers import final_plan
from pyspark.sql import functions as F

from fareloom.operators.quality import QualityError, quality_report, require_quality
from fareloom.plans.dialects import FARE_PARTS, GREEN, HVFHV
from fareloom.plans.fact_bookings import BLOCKING_CHECKS, FACT_CHECKS, fact_bookings
from fareloom.plans.tables import FACT_BOOKINGS

DAY = "2024-06-01 "


def fact(make_trips, rates, *row):
    return fact_bookings(make_trips([row]), rates, GREEN).first()


def test_contract_shape():
    assert len(FACT_BOOKINGS) == 38
    assert sum(not field.nullable for field in FACT_BOOKINGS) == 15
    assert FACT_BOOKINGS.fieldNames()[-3:] == ["year", "month", "day"]


def test_normal_trip(make_trips, june_rates):
    row = fact(make_trips, june_rates, DAY + "10:00:00", DAY + "10:30:00", 5.0, 20.0)
    assert row.asDict() == {
        "booking_date_key": 20240601,
        "pu_date_key": 20240601,
        "pu_hour_key": 2024060110,
        "do_date_key": 20240601,
        "do_hour_key": 2024060110,
        "pu_location_key": 1,
        "do_location_key": 2,
        "platform_key": "2",
        "source_currency": "USD",
        "request_datetime": dt.datetime(2024, 6, 1, 10, 0),
        "pickup_datetime": dt.datetime(2024, 6, 1, 10, 0),
        "dropoff_datetime": dt.datetime(2024, 6, 1, 10, 30),
        "trip_miles": 5.0,
        "trip_mins": 30.0,
        "trip_efficiency": 5 / 30,
        "speed_mile_per_hour": 10.0,
        "base_passenger_fare": 8.0,
        "tolls": 0.5,
        "bcf": 0.0,
        "sales_tax": 0.25,
        "congestion_surcharge": 2.75,
        "airport_fee": 0.0,
        "tips": 1.0,
        "total_fare": 20.0,
        "total_fare_gbp": 16.0,
        "total_fare_eur": 18.0,
        "driver_pay": None,
        "driver_pay_gbp": None,
        "driver_pay_eur": None,
        "gbp_rate": 0.8,
        "eur_rate": 0.9,
        "shared_request_flag": False,
        "shared_match_flag": False,
        "wav_request_flag": False,
        "wav_match_flag": False,
        "year": "2024",
        "month": "06",
        "day": "01",
    }


@pytest.mark.parametrize(
    "pickup, dropoff, miles, total, expected",
    [
        ("10:00:00", "10:02:00", 5.0, 10.0, {"trip_efficiency": None, "speed_mile_per_hour": 150.0}),
        ("10:00:00", "10:30:00", 1.0, 10.0, {"trip_efficiency": None, "speed_mile_per_hour": 2.0}),
        ("10:00:00", "10:00:00", 5.0, 10.0, {"trip_mins": 0.0, "speed_mile_per_hour": None, "trip_efficiency": None}),
        ("10:30:00", "10:00:00", 5.0, 9.0, {"trip_mins": -30.0, "speed_mile_per_hour": -10.0, "trip_efficiency": None}),
        ("10:00:00", "10:30:00", None, 10.0, {"speed_mile_per_hour": None, "trip_efficiency": None, "trip_mins": 30.0}),
    ],
)
def test_edge_trips(make_trips, june_rates, pickup, dropoff, miles, total, expected):
    row = fact(make_trips, june_rates, DAY + pickup, DAY + dropoff, miles, total).asDict()
    assert {name: row[name] for name in expected} == expected


def test_trip_without_rate_is_kept(make_trips, june_rates):
    row = fact(make_trips, june_rates, "2024-06-02 10:00:00", "2024-06-02 10:30:00", 5.0, 20.0)
    assert (row.gbp_rate, row.eur_rate, row.total_fare_gbp, row.total_fare_eur) == (None,) * 4
    assert row.total_fare == 20.0


def test_types_follow_the_contract(make_trips, june_rates):
    facts = fact_bookings(make_trips([(DAY + "10:00:00", DAY + "10:30:00", 5.0, 20.0)]), june_rates, GREEN)
    assert facts.dtypes == [(field.name, field.dataType.simpleString()) for field in FACT_BOOKINGS]


def test_unusable_raw_values_become_null(make_trips, june_rates):
    trips = make_trips([(DAY + "10:00:00", DAY + "10:30:00", 5.0, 20.0)])
    odd = trips.withColumns({"trip_distance": F.lit("far"), "PULocationID": F.lit(2**40)})
    row = fact_bookings(odd, june_rates, GREEN).first()
    assert row.trip_miles is None and row.pu_location_key is None and row.total_fare == 20.0


@pytest.fixture
def hvfhv(spark):
    def build(**changes):
        base = {
            "hvfhs_license_num": "HV0003",
            "request_datetime": dt.datetime(2024, 5, 31, 23, 58),
            "pickup_datetime": dt.datetime(2024, 6, 1, 0, 3),
            "dropoff_datetime": dt.datetime(2024, 6, 1, 0, 33),
            "PULocationID": 10,
            "DOLocationID": 20,
            "trip_miles": 6.0,
            "trip_time": 1800,
            **{part: float(i) for i, part in enumerate(FARE_PARTS, 1)},
            "driver_pay": 20.0,
            "shared_request_flag": "Y",
            "shared_match_flag": "N",
            "wav_request_flag": " ",
            "wav_match_flag": None,
            **changes,
        }
        kinds = {
            **dict.fromkeys(["request_datetime", "pickup_datetime", "dropoff_datetime"], "timestamp_ntz"),
            **dict.fromkeys(["PULocationID", "DOLocationID"], "int"),
            "trip_time": "bigint",
            **dict.fromkeys(["trip_miles", "driver_pay", *FARE_PARTS], "double"),
        }
        ddl = ", ".join(f"{name} {kinds.get(name, 'string')}" for name in base)
        return spark.createDataFrame([tuple(base.values())], ddl)

    return build


def test_for_hire_trip(hvfhv, make_rates):
    rates = make_rates([("USD", "GBP", "2024-05-31", 0.5), ("USD", "GBP", "2024-06-01", 0.8)])
    row = fact_bookings(hvfhv(), rates, HVFHV).first()
    assert (row.booking_date_key, row.pu_date_key, row.pu_hour_key) == (20240531, 20240601, 2024060100)
    assert (row.year, row.month, row.day) == ("2024", "05", "31")
    assert (row.trip_mins, row.speed_mile_per_hour, row.trip_efficiency) == (30.0, 12.0, 0.2)
    assert (row.total_fare, row.total_fare_gbp, row.driver_pay_gbp) == (28.0, 14.0, 10.0)
    assert (row.gbp_rate, row.eur_rate, row.driver_pay_eur) == (0.5, None, None)
    assert (row.shared_request_flag, row.shared_match_flag) == (True, False)
    assert (row.wav_request_flag, row.wav_match_flag) == (None, None)
    assert row.platform_key == "HV0003"


def test_for_hire_total_needs_every_part(hvfhv, june_rates):
    row = fact_bookings(hvfhv(tips=None), june_rates, HVFHV).first()
    assert row.total_fare is None and row.total_fare_gbp is None and row.driver_pay == 20.0


def test_for_hire_time_comes_from_the_meter(hvfhv, june_rates):
    row = fact_bookings(hvfhv(trip_time=0), june_rates, HVFHV).first()
    assert (row.trip_mins, row.speed_mile_per_hour, row.trip_efficiency) == (0.0, None, None)


def test_dialects_name_what_they_read():
    assert len(GREEN.columns()) == 12
    assert len(HVFHV.columns()) == 20


def test_trips_are_not_shuffled(spark, make_trips, june_rates, tmp_path):
    make_trips([(DAY + "10:00:00", DAY + "10:30:00", 5.0, 20.0)]).write.parquet(str(tmp_path / "trips"))
    plan = final_plan(fact_bookings(spark.read.parquet(str(tmp_path / "trips")), june_rates, GREEN))
    assert "SortMergeJoin" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert plan.count("BroadcastHashJoin") == 1


CHECK_NAMES = [check.name for check in BLOCKING_CHECKS]


@pytest.mark.parametrize(
    "row, counts",
    [
        ((DAY + "10:00:00", DAY + "10:30:00", 5.0, 10000.0), [0, 0, 0]),
        ((DAY + "10:00:00", DAY + "10:30:00", 5.0, 10000.01), [0, 1, 0]),
        ((DAY + "10:30:00", DAY + "10:00:00", 5.0, 10.0), [0, 0, 1]),
        ((DAY + "10:00:00", DAY + "10:00:00", 5.0, None), [0, 0, 0]),
        ((None, DAY + "10:30:00", 5.0, 10.0), [1, 0, 0]),
    ],
)
def test_quality_counts(make_trips, june_rates, row, counts):
    report = quality_report(fact_bookings(make_trips([row]), june_rates, GREEN), BLOCKING_CHECKS)
    assert report.columns == ["check_name", "violations", "blocking"]
    assert [(r.check_name, r.violations) for r in report.collect()] == list(zip(CHECK_NAMES, counts))


def test_gate_names_every_failed_check(make_trips, june_rates):
    facts = fact_bookings(
        make_trips([(None, DAY + "10:30:00", 5.0, 10.0), (DAY + "10:30:00", DAY + "10:00:00", 5.0, 20000.0)]),
        june_rates,
        GREEN,
    )
    with pytest.raises(QualityError) as error:
        require_quality(facts, FACT_CHECKS)
    assert error.value.failures == dict.fromkeys(CHECK_NAMES, 1)


def test_other_nulls_are_reported_but_do_not_block(make_trips, june_rates):
    facts = fact_bookings(
        make_trips([(DAY + "10:00:00", DAY + "10:30:00", 5.0, 10.0, {"pu": None})]), june_rates, GREEN
    )
    report = {row.check_name: row.violations for row in require_quality(facts, FACT_CHECKS)}
    assert report["pu_location_key is null"] == 1
    assert sum(report.values()) == 1


def test_all_checks_share_one_scan(spark, make_trips, june_rates, tmp_path):
    facts = fact_bookings(make_trips([(DAY + "10:00:00", DAY + "10:30:00", 5.0, 20.0)]), june_rates, GREEN)
    facts.write.parquet(str(tmp_path / "facts"))
    plan = final_plan(quality_report(spark.read.parquet(str(tmp_path / "facts")), FACT_CHECKS))
    assert plan.count("FileScan parquet") == 1
    assert "tips" not in plan.split("ReadSchema")[1]


def test_empty_table_passes(spark, make_trips, june_rates):
    facts = fact_bookings(make_trips([(DAY + "10:00:00", DAY + "10:30:00", 5.0, 20.0)]), june_rates, GREEN)
    assert all(row.violations == 0 for row in require_quality(facts.limit(0), BLOCKING_CHECKS))
