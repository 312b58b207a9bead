from __future__ import annotations

import datetime as dt
import os
import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]

from strata.session import local_session  # noqa: E402
from strata.sources.trip_view import read_given_table, trip_view  # noqa: E402

DATA = os.environ.get("STRATA_TEST_DATA", "/root/testdata/sf0.001")

TRIP_DDL = (
    "VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "passenger_count bigint, trip_distance double, RatecodeID bigint, PULocationID int, DOLocationID int, "
    "fare_amount double, tip_amount double, total_amount double, congestion_surcharge double, "
    "improvement_surcharge double, airport_fee double"
)

BASE_TRIP = {
    "VendorID": 1,
    "tpep_pickup_datetime": dt.datetime(2023, 3, 1, 10, 0),
    "tpep_dropoff_datetime": dt.datetime(2023, 3, 1, 10, 20),
    "passenger_count": 1,
    "trip_distance": 2.0,
    "RatecodeID": 1,
    "PULocationID": 1,
    "DOLocationID": 263,
    "fare_amount": 10.0,
    "tip_amount": 2.5,
    "total_amount": 12.5,
    "congestion_surcharge": 2.5,
    "improvement_surcharge": 1.0,
    "airport_fee": None,
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4,
        "strata-tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data() -> str:
    return DATA


@pytest.fixture(scope="session")
def trip_rows(spark):
    """A DataFrame of trips, each the base trip with some fields changed."""

    def make(*changes: dict):
        rows = [tuple((BASE_TRIP | change).values()) for change in changes]
        return spark.createDataFrame(rows, TRIP_DDL)

    return make


@pytest.fixture(scope="session")
def view(spark, data):
    return trip_view(read_given_table(spark, data, "lineitem"))


def explained(rows, mode: str = "formatted") -> str:
    import contextlib
    import io

    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        rows.explain(mode)
    return text.getvalue()
