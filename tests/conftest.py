import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from fareloom.session import open_session  # noqa: E402

TRIP_COLUMNS = (
    "VendorID int, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz, PULocationID int, "
    "DOLocationID int, trip_distance double, fare_amount double, tolls_amount double, mta_tax double, "
    "congestion_surcharge double, tip_amount double, total_amount double"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = open_session(
        "tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(base / "shared"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_trips(spark):
    """Street-hail trips from (pick-up, drop-off, miles, total) and optional other columns."""
    import datetime as dt

    def moment(text):
        return dt.datetime.fromisoformat(text) if text else None

    def build(rows):
        full = []
        for row in rows:
            pickup, dropoff, miles, total = row[:4]
            extra = row[4] if len(row) > 4 else {}
            full.append(
                (
                    extra.get("vendor", 2),
                    moment(pickup),
                    moment(dropoff),
                    extra.get("pu", 1),
                    extra.get("do", 2),
                    miles,
                    extra.get("fare", 8.0),
                    0.5,
                    0.25,
                    2.75,
                    extra.get("tip", 1.0),
                    total,
                )
            )
        return spark.createDataFrame(full, TRIP_COLUMNS)

    return build


@pytest.fixture(scope="session")
def make_rates(spark):
    def build(rows):
        return spark.createDataFrame(
            rows, "from_currency string, to_currency string, exchange_rate_date string, rate double"
        )

    return build


@pytest.fixture(scope="session")
def june_rates(make_rates):
    return make_rates([("USD", "GBP", "2024-06-01", 0.8), ("USD", "EUR", "2024-06-01", 0.9)])


@pytest.fixture(scope="session")
def locations(spark):
    return spark.createDataFrame(
        [
            (1, "Queens", "Corona", "Boro Zone"),
            (2, "Queens", "Corona", "Boro Zone"),
            (3, "Bronx", "Belmont", "Boro Zone"),
            (264, "Unknown", "N/A", "N/A"),
        ],
        "LocationID int, Borough string, Zone string, service_zone string",
    )
