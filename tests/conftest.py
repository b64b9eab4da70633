import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from loglake.session import build_session

    session = build_session(
        "loglake-tests",
        "local[8]",
        **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="loglake-tests-"), "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": 8, "spark.driver.memory": "6g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL
