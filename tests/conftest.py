import os

import pytest

from tallyguard.session import build_session

SF_DIR = os.environ.get("TALLYGUARD_TEST_SF", "/root/testdata/sf0.001")


def test_session():
    spark = build_session("tallyguard-tests", "local[8]", {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g", "spark.driver.bindAddress": "127.0.0.1",
        "spark.driver.host": "127.0.0.1"})
    spark.sparkContext.setLogLevel("ERROR")
    return spark


test_session.__test__ = False


@pytest.fixture(scope="session")
def spark():
    return test_session()
