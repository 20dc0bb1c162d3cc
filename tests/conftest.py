"""One session for all tests."""

import tempfile

import pytest

from strandloom.session import session


@pytest.fixture(scope="session")
def spark():
    with tempfile.TemporaryDirectory(prefix="strandloom-tests-") as folder:
        found = session("tests", **{"spark.master": "local[8]", "spark.driver.memory": "6g", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.checkpoint.dir": f"file://{folder}/checkpoint", "spark.sql.warehouse.dir": f"{folder}/warehouse"})
        found.sparkContext.setLogLevel("ERROR")
        yield found
        found.stop()
