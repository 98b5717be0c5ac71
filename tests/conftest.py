import os
import sys
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TRIP_SCHEMA = (
    "source_month DATE, tpep_pickup_datetime TIMESTAMP_NTZ, tpep_dropoff_datetime TIMESTAMP_NTZ,"
    " PULocationID BIGINT, trip_distance DOUBLE, fare_amount DOUBLE, total_amount DOUBLE"
)
JUNE = date(2023, 6, 1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("curbline-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return DATA


def ride(start, minutes, miles, fare, total, zone=7, month=JUNE):
    """A trip of so many minutes; without a start it has an end only."""
    if start is None:
        return (month, None, datetime(month.year, month.month, 10, 12), zone, miles, fare, total)
    at = datetime.fromisoformat(start)
    return (month, at, at + timedelta(minutes=minutes), zone, miles, fare, total)


# Two ordinary rides of zone 7, one row for each defect and for some pairs of them, and zone 19.
CASES = [
    ride("2023-06-10T08:00", 12, 3.2, 14.5, 18.0),
    ride("2023-06-10T09:30", 24, 7.4, 28.0, 33.5),
    ride("2023-06-10T18:00", 25, 301.0, 90.0, 99.0),  # too far, and too fast for it
    ride("2023-06-10T12:00", 20, 45.0, 60.0, 66.0),  # 135 miles an hour
    ride("2023-06-10T11:00", 5, 0.0, 6.0, 7.25),  # stood still
    ride("2023-06-10T13:00", 510, 12.0, 80.0, 88.0),  # longer than eight hours
    ride("2023-06-10T14:10", 0, 1.1, 7.0, 8.8),  # over as it began
    ride("2023-06-10T15:00", 18, 5.0, -3.0, 4.4),  # fare below zero, charged all the same
    ride("2023-06-10T16:00", 9, 2.6, 0.0, 0.0),  # nothing charged
    ride("2023-06-10T17:00", 10, 1.5, -9.0, -11.5),  # money back
    ride("2023-07-01T00:05", 15, 4.0, 15.0, 17.0),  # of the next month
    ride("2023-06-11T07:00", 30, 9.9, 35.0, 41.0, zone=19),
    ride("2023-05-31T23:59", 11, 2.0, 9.0, -10.0, zone=19),  # of the month before, and money back
]


@pytest.fixture(scope="session")
def trips(spark):
    return spark.createDataFrame(CASES, TRIP_SCHEMA)


@pytest.fixture(scope="session")
def zones(spark):
    return spark.createDataFrame(
        [(7, "North", "Old Harbour", "Boats"), (19, "South", "Mill Lane", "Trams")],
        "location_id INT, borough STRING, zone STRING, service_zone STRING",
    )
