import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("sparkelt-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.debug.maxToStringFields", "1000")
        .config("spark.sql.maxMetadataStringLength", "100000")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("catalog")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def warehouse(spark, tmp_path):
    from sparkelt.sources.warehouse import Warehouse

    return Warehouse(spark, str(tmp_path / "wh"))


@pytest.fixture(scope="session")
def trip_row():
    """A good raw green trip; keyword arguments replace fields."""
    from datetime import datetime

    base = {
        "trip_id": "t1",
        "VendorID": 1,
        "lpep_pickup_datetime": datetime(2024, 1, 5, 10, 0),
        "lpep_dropoff_datetime": datetime(2024, 1, 5, 10, 30),
        "store_and_fwd_flag": "N",
        "RatecodeID": 1,
        "PULocationID": 10,
        "DOLocationID": 20,
        "passenger_count": 1,
        "trip_distance": 2.5,
        "fare_amount": 10.0,
        "extra": 0.5,
        "mta_tax": 0.5,
        "tip_amount": 0.0,
        "tolls_amount": 0.0,
        "ehail_fee": 0.0,
        "improvement_surcharge": 0.3,
        "total_amount": 11.3,
        "payment_type": 1,
        "trip_type": 1,
        "congestion_surcharge": 0.0,
        "loaded_at": datetime(2024, 2, 1, 8, 0),
    }

    def make(**changes):
        row = base | changes
        return tuple(row[n] for n in base)

    return make
