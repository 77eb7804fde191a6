"""How each raw trip format names the inputs of the fact table."""

from __future__ import annotations

from dataclasses import dataclass, field

# The seven parts of a fare, in the order in which they are added.
FARE_PARTS = (
    "base_passenger_fare",
    "tolls",
    "bcf",
    "sales_tax",
    "congestion_surcharge",
    "airport_fee",
    "tips",
)
FLAGS = ("shared_request_flag", "shared_match_flag", "wav_request_flag", "wav_match_flag")


@dataclass(frozen=True)
class Dialect:
    """Raw column names. ``None`` means that the format lacks the column; the fact build says what replaces it."""

    name: str
    platform: str
    requested: str
    picked_up: str
    dropped_off: str
    miles: str
    pickup_location: str = "PULocationID"
    dropoff_location: str = "DOLocationID"
    seconds: str | None = None
    fare_parts: dict[str, str] = field(default_factory=dict)
    total: str | None = None
    driver_pay: str | None = None
    flags: bool = False
    currency: str = "USD"

    def columns(self) -> list[str]:
        """Every raw column the fact build reads."""
        optional = [name for name in (self.seconds, self.total, self.driver_pay) if name]
        wanted = [
            self.platform,
            self.requested,
            self.picked_up,
            self.dropped_off,
            self.pickup_location,
            self.dropoff_location,
            self.miles,
            *optional,
            *self.fare_parts.values(),
            *(FLAGS if self.flags else ()),
        ]
        return list(dict.fromkeys(wanted))


# Raw column names of street-hail trips. They carry no request time, no driver pay and no flags.
GREEN = Dialect(
    name="green",
    platform="VendorID",
    requested="lpep_pickup_datetime",
    picked_up="lpep_pickup_datetime",
    dropped_off="lpep_dropoff_datetime",
    miles="trip_distance",
    fare_parts={
        "base_passenger_fare": "fare_amount",
        "tolls": "tolls_amount",
        "sales_tax": "mta_tax",
        "congestion_surcharge": "congestion_surcharge",
        "tips": "tip_amount",
    },
    total="total_amount",
)

# Raw column names of high-volume for-hire trips.
HVFHV = Dialect(
    name="hvfhv",
    platform="hvfhs_license_num",
    requested="request_datetime",
    picked_up="pickup_datetime",
    dropped_off="dropoff_datetime",
    miles="trip_miles",
    seconds="trip_time",
    fare_parts={part: part for part in FARE_PARTS},
    driver_pay="driver_pay",
    flags=True,
)

DIALECTS = {dialect.name: dialect for dialect in (GREEN, HVFHV)}
