import logging
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from clinisift.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[8]", "tests", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g", "spark.driver.bindAddress": "127.0.0.1", "spark.driver.host": "127.0.0.1"})
    s.sparkContext.setLogLevel("OFF")
    logging.disable(logging.ERROR)
    yield s
    s.stop()
