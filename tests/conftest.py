import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FIXTURES = os.path.join(ROOT, "tests", "fixtures")
SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from stratum.session import build_session

    warehouse = tempfile.mkdtemp(prefix="stratum-wh-")
    session = build_session(
        "local[*]",
        app_name="stratum-tests",
        shuffle_partitions=8,
        extra={"spark.ui.enabled": "false", "spark.sql.warehouse.dir": warehouse},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="stratum-test-")


@pytest.fixture(scope="session")
def fixture_source(spark):
    from stratum.sources.orders import read_order_csv

    return read_order_csv(spark, os.path.join(FIXTURES, "source_orders.csv"))
