"""Contracts of the published tables and schemas of the dimension files."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES: dict[str, DataType] = {
    "int": IntegerType(),
    "string": StringType(),
    "timestamp": TimestampType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
}


def declared(text: str) -> StructType:
    """Schema from ``name type [not null]`` items; unlike a DDL parse it needs no running session."""
    fields = [item.split() for item in text.split(",")]
    return StructType([StructField(name, _TYPES[kind], not rest) for name, kind, *rest in fields])


# Columns, types and nullability of the fact table, in published order. The last three are the
# partition columns.
FACT_BOOKINGS = declared(
    """
    booking_date_key int not null,
    pu_date_key int not null,
    pu_hour_key int not null,
    do_date_key int not null,
    do_hour_key int not null,
    pu_location_key int not null,
    do_location_key int not null,
    platform_key string not null,
    source_currency string not null,
    request_datetime timestamp not null,
    pickup_datetime timestamp not null,
    dropoff_datetime timestamp not null,
    trip_miles double,
    trip_mins double,
    trip_efficiency double,
    speed_mile_per_hour double,
    base_passenger_fare double,
    tolls double,
    bcf double,
    sales_tax double,
    congestion_surcharge double,
    airport_fee double,
    tips double,
    total_fare double,
    total_fare_gbp double,
    total_fare_eur double,
    driver_pay double,
    driver_pay_gbp double,
    driver_pay_eur double,
    gbp_rate double,
    eur_rate double,
    shared_request_flag boolean,
    shared_match_flag boolean,
    wav_request_flag boolean,
    wav_match_flag boolean,
    year string not null,
    month string not null,
    day string not null
    """
)

# The location file as its header names it, and as the catalog names it.
LOCATION_FILE = declared("LocationID int, Borough string, Zone string, service_zone string")
DIM_LOCATION = declared("location_id int, borough string, zone string, service_zone string")
DIM_PLATFORM = declared("platform_key string, platform_name string")
EXCHANGE_RATES = declared(
    "from_currency string, to_currency string, exchange_rate_date string, rate double"
)
