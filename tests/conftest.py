import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from tradeloom import build_session  # noqa: E402
from tradeloom.config import shared_dir  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    session = build_session("tradeloom-tests", "local[8]", **settings)
    session.sparkContext.setLogLevel("OFF")
    shared_dir(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return f"{DATA}/sf0.01"


@pytest.fixture(scope="session")
def small_sf():
    return f"{DATA}/sf0.001"
