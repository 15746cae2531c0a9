from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = sys.path[0] + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    from tidewright.runtime import build_session

    session = build_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "4", "spark.driver.memory": "3g", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_dir():
    path = os.environ.get("TIDEWRIGHT_TESTDATA", "/root/testdata/sf0.001")
    if not os.path.isdir(path):
        pytest.skip("no test tables")
    return path
