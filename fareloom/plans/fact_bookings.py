"""The fact build: raw trips of either dialect plus exchange rates to the fact table's columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions.measures import converted, miles_per_hour, miles_per_minute, strict_total, yes_no_flag
from fareloom.functions.temporal import date_key, elapsed_seconds, hour_key, minutes, partition_values
from fareloom.operators.contracts import conform
from fareloom.operators.quality import Check
from fareloom.operators.rates import attach_rates, rate_column
from fareloom.plans.dialects import FARE_PARTS, FLAGS, Dialect
from fareloom.plans.tables import FACT_BOOKINGS

CURRENCIES = ("GBP", "EUR")
# Columns of the curated rows that only the build itself needs.
_SECONDS = "__seconds"
_BOOKED = "__booked"

# Names and rules of the blocking checks.
BLOCKING_CHECKS = (
    Check("null_check", "source_currency IS NULL OR request_datetime IS NULL"),
    Check("large_values_check", "total_fare > 10000"),
    Check("date_consistency_check", "dropoff_datetime < pickup_datetime"),
)
# Nulls in other mandatory columns are counted in the same scan but do not stop a load.
FACT_CHECKS = BLOCKING_CHECKS + tuple(
    Check(f"{field.name} is null", f"{field.name} IS NULL", blocking=False)
    for field in FACT_BOOKINGS
    if not field.nullable and field.name not in ("source_currency", "request_datetime")
)


def curated_trips(raw: DataFrame, dialect: Dialect) -> DataFrame:
    """Raw trips projected onto fact columns, before currencies.

    Raw values that do not fit the declared type become null rather than failing the job.
    """

    def double(name: str | None, otherwise: float | None) -> Column:
        return F.col(name).try_cast("double") if name else F.lit(otherwise).cast("double")

    requested, picked_up, dropped_off = (
        F.col(name) for name in (dialect.requested, dialect.picked_up, dialect.dropped_off)
    )
    seconds = double(dialect.seconds, None) if dialect.seconds else elapsed_seconds(picked_up, dropped_off)
    miles = double(dialect.miles, None)
    parts = {part: double(dialect.fare_parts.get(part), 0.0) for part in FARE_PARTS}
    flags = {flag: yes_no_flag(flag) if dialect.flags else F.lit(False) for flag in FLAGS}
    columns = {
        "platform_key": F.col(dialect.platform).cast("string"),
        "source_currency": F.lit(dialect.currency),
        "request_datetime": requested.cast("timestamp"),
        "pickup_datetime": picked_up.cast("timestamp"),
        "dropoff_datetime": dropped_off.cast("timestamp"),
        "booking_date_key": date_key(requested),
        "pu_date_key": date_key(picked_up),
        "pu_hour_key": hour_key(picked_up),
        "do_date_key": date_key(dropped_off),
        "do_hour_key": hour_key(dropped_off),
        "pu_location_key": F.col(dialect.pickup_location).try_cast("int"),
        "do_location_key": F.col(dialect.dropoff_location).try_cast("int"),
        "trip_miles": miles,
        "trip_mins": minutes(seconds),
        "speed_mile_per_hour": miles_per_hour(miles, seconds),
        **parts,
        "total_fare": double(dialect.total, None) if dialect.total else strict_total(*parts.values()),
        "driver_pay": double(dialect.driver_pay, None),
        **flags,
        **partition_values(requested),
        _SECONDS: seconds,
        _BOOKED: F.to_date(requested),
    }
    return raw.select(*[column.alias(name) for name, column in columns.items()])


def fact_bookings(raw: DataFrame, rates: DataFrame, dialect: Dialect, on_duplicate_rate: str = "error") -> DataFrame:
    """Raw trips and dated rates to the fact table's 38 columns; no trip is dropped.

    The trips are never shuffled: the rates of the source currency are one row per day, and are broadcast after their
    size has been measured.
    """
    curated = curated_trips(raw, dialect)
    trips = curated.withColumn("trip_efficiency", miles_per_minute("trip_miles", _SECONDS))
    priced = attach_rates(
        trips,
        rates.where(F.col("from_currency") == dialect.currency),
        CURRENCIES,
        currency="source_currency",
        day=F.col(_BOOKED),
        on_duplicate=on_duplicate_rate,
        spread_by=["pickup_datetime", "dropoff_datetime", "pu_location_key", "do_location_key", "trip_miles"],
    )
    amounts = {
        f"{amount}_{currency.lower()}": converted(amount, rate_column(currency))
        for amount in ("total_fare", "driver_pay")
        for currency in CURRENCIES
    }
    return conform(priced.withColumns(amounts), FACT_BOOKINGS)
