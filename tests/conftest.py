import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reelspark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    extra = {
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    session = build_session("tests", master="local[4]", shuffle_partitions=4, extra=extra)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
